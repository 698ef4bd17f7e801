"""N-gram Jaccard join (operator 4): all links between texts whose sets of five-word shingles have a Jaccard similarity of at
least 0.75, found by rare-first prefix filtering with length, positional and suffix filters, each pair verified once.

How it works.  (1) Blocks of documents hash their shingles and send the distinct ones, by hash range, to reducers, which sum
how many documents have each; a block sends a shingle once however many of its documents hold it.  (2) What more than one
document holds goes back to the blocks with its frequency.  As shingles of one document alone come first in rare-first order
and match nothing, a text with fewer repeated shingles than any partner would need is done.  (3) The rest are reduced to one
per word sequence; their prefixes, rarest first, join texts into candidate clusters, whose texts are dealt to sides of about
CLUSTER_TEXTS.  (4) In each side, prefix postings give candidate pairs; the length, positional and suffix bounds prune them; what
is left is verified once per pair by exact overlap, unless both texts are already known to be linked.  (5) Clusters of several
sides: the links so far give components.  A prefix shingle whose texts lie in one component needs nothing more.  Of any other, the texts
outside its largest component visit the sides where a text of another component holds that shingle, and are verified against the
texts there.  So a text travels only to where it has candidates, and a large group of copies stays where it is.  (6) Links become components.

Defined results.  Null, empty and white-space texts: empty set, linked with nothing, a component of their own.  Fewer than
five words: the whole sequence is the one shingle.  Repeated rows fall in one component.  Empty table: no rows.  Further
columns are ignored.  A null doc_id names nothing: its row gets the component that its text has among the others, else null.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardloom.llm.common import spread_join, staged, trim_memory, with_small_batches
from cardloom.llm.graph import connected_components
from cardloom.llm.shingles import hashed_texts

#: Shingles that a reducer takes, about; bytes of text to a shingle, about; the least number of reducers.
BUCKET_SHINGLES = 2_000_000
SHINGLE_BYTES = 6
LEAST_BUCKETS = 32
#: Rows (their numbers have 16 bits) and bytes of text of a block.
BLOCK_ROWS = 10_000
BLOCK_BYTES = 8 << 20
#: Texts of a side of a candidate cluster, about, and visitors that a task verifies against those of a side.
CLUSTER_TEXTS = 1024

_TOKEN_BITS = 48
_U = np.uint64
_BLOCK_SCHEMA = "bucket int, block long, head boolean, blob binary"


def least_overlap(n: np.ndarray | int, percent: int):
    """Shingles that any partner shares with a set of n."""
    return -(-percent * n // 100)


def _packed(value) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(value, protocol=5))


def _unpacked(blob: bytes):
    return pickle.loads(zstandard.ZstdDecompressor().decompress(blob))


def _planes(tokens: np.ndarray) -> np.ndarray:
    """The six low bytes of sorted tokens, byte by byte: the upper ones then compress to almost nothing."""
    return np.ascontiguousarray(tokens.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:].T)


def _from_planes(planes: np.ndarray) -> np.ndarray:
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, 2:] = planes.T
    return out.view(">u8").ravel().astype(_U)


def _block_rows(ids: pa.Array, texts: pa.Array, block: int, buckets: int) -> Iterator[tuple[int, int, bool, bytes]]:
    """A block's rows: its head, then its distinct shingle tokens by bucket, each with its number of documents here."""
    sizes, keys1, keys2, tokens, own = [], [], [], [], []
    seen: set[tuple[int, int]] = set()
    for at, part in hashed_texts(texts):
        for i, shingles in enumerate(part.shingles):
            key = (int(part.key1[i]), int(part.key2[i]))
            sizes.append(len(shingles))
            if len(shingles) and key not in seen:  # of exact copies in a block the first stands for all
                seen.add(key)
                token = np.unique(shingles >> _U(64 - _TOKEN_BITS))
                tokens.append((token << _U(16)) | _U(at + i))
                own.append(at + i)
        keys1.append(part.key1)
        keys2.append(part.key2)
    # these arrays are a block's largest: each is let go as soon as the next is made, as all tasks of an executor have one of each
    posted = np.concatenate(tokens) if tokens else np.zeros(0, _U)
    tokens.clear()
    posted.sort()
    holder = posted.astype(np.uint16)  # the low bits
    posted >>= _U(16)
    first = np.ones(len(posted), dtype=bool)
    np.not_equal(posted[1:], posted[:-1], out=first[1:])
    distinct = posted[first]
    many = len(posted)
    del posted
    held = np.diff(np.flatnonzero(first).astype(np.uint32), append=np.uint32(many)).astype(np.uint16)
    del first
    cuts = np.searchsorted(distinct, np.array([-(-b * (1 << _TOKEN_BITS) // buckets) for b in range(buckets + 1)], dtype=_U))
    head = {
        "ids": np.array(ids.fill_null(0)), "id_null": np.array(ids.is_null()), "n": np.array(sizes, np.int64), "own": np.array(own, np.int64),
        "key1": np.concatenate(keys1), "key2": np.concatenate(keys2), "cuts": cuts, "held": held, "holder": np.ascontiguousarray(holder.view(np.uint8).reshape(-1, 2).T),
    }
    # a block is numbered by its partition and its place there: heads spread over the buckets by both
    yield ((block >> 24) + (block & 0xFFFFFF)) % buckets, block, True, _packed(head)
    for b in range(buckets):
        if cuts[b] < cuts[b + 1]:
            yield b, block, False, _packed((_planes(distinct[cuts[b] : cuts[b + 1]]), held[cuts[b] : cuts[b + 1]]))


def _arrow_rows(rows: list[tuple]) -> pa.RecordBatch:
    bucket, block, head, blob = zip(*rows) if rows else ((), (), (), ())  # a bucket may have nothing to send back
    return pa.RecordBatch.from_arrays([pa.array(bucket, pa.int32()), pa.array(block, pa.int64()), pa.array(head, pa.bool_()), pa.array(blob, pa.binary())], ["bucket", "block", "head", "blob"])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, pa.Array]]:
    """doc_ids and texts of blocks of at most BLOCK_ROWS rows and, but for longer single batches, BLOCK_BYTES of text."""
    held: list[pa.RecordBatch] = []
    rows = size = 0
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK_ROWS):
            some = batch.slice(at, BLOCK_ROWS)
            more = some.column(1).nbytes
            if held and (rows + some.num_rows > BLOCK_ROWS or size + more > BLOCK_BYTES):
                table = pa.Table.from_batches(held).combine_chunks()
                yield table.column(0).combine_chunks(), table.column(1).combine_chunks()
                held, rows, size = [], 0, 0
            held.append(some)
            rows, size = rows + some.num_rows, size + more
    if held:
        table = pa.Table.from_batches(held).combine_chunks()
        yield table.column(0).combine_chunks(), table.column(1).combine_chunks()


def _block_sender(buckets: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 24
        for ids, texts in _blocks(batches):
            waiting, size = [], 0
            for row in _block_rows(ids, texts, block, buckets):
                waiting.append(row)
                size += len(row[3])
                if size > 4 << 20:
                    yield _arrow_rows(waiting)
                    waiting, size = [], 0
            if waiting:
                yield _arrow_rows(waiting)
            block += 1
        trim_memory()

    return send


def _count_bucket(rows):
    """Of a bucket's shingles, those of more than one document go back to their blocks, with the number of documents."""
    out: list[tuple[int, int, bool, bytes]] = []
    tokens, held, blocks = [], [], []
    bucket = rows.column("bucket")[0].as_py()
    for head, block, blob in zip(rows.column("head").to_pylist(), rows.column("block").to_pylist(), rows.column("blob")):
        if head:
            out.append((bucket, block, True, blob.as_py()))
        else:
            planes, counts = _unpacked(blob.as_py())
            tokens.append(_from_planes(planes))
            held.append(counts)
            blocks.append(block)
    if tokens:
        ends = np.cumsum([len(x) for x in tokens])
        every = np.concatenate(tokens)
        order = np.argsort(every, kind="stable")
        ranked = every[order]
        starts = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
        total = np.add.reduceat(np.concatenate(held)[order].astype(np.int64), starts)
        spread = np.repeat(total, np.diff(np.append(starts, len(ranked))))
        again = spread > 1
        place, count = order[again], spread[again]
        back = np.argsort(place)
        place, count = place[back], count[back]
        cuts = np.searchsorted(place, np.concatenate([[0], ends]))
        for k, block in enumerate(blocks):
            if cuts[k] < cuts[k + 1]:
                at = place[cuts[k] : cuts[k + 1]]
                out.append((bucket, block, False, _packed(((at - (ends[k] - len(tokens[k]))).astype(np.uint32), _planes(every[at]), np.minimum(count[cuts[k] : cuts[k + 1]], 0xFFFF).astype(np.uint16)))))
    done = pa.Table.from_batches([_arrow_rows(out)])
    trim_memory()
    return done


def _block_joiner(percent: int):
    def join(rows):
        head, parts = None, []
        for is_head, bucket, blob in zip(rows.column("head").to_pylist(), rows.column("bucket").to_pylist(), rows.column("blob")):
            if is_head:
                head = _unpacked(blob.as_py())
            else:
                parts.append((bucket, *_unpacked(blob.as_py())))
        n = head["n"]
        holder = np.ascontiguousarray(head["holder"].T).view(np.uint16).ravel()
        held = head["held"].astype(np.int64)
        first = np.concatenate([[0], np.cumsum(held)])[:-1]
        docs, keys = [], []
        for bucket, place, planes, count in parts:
            at = place.astype(np.int64) + head["cuts"][bucket]
            wide = held[at]
            inner = np.arange(wide.sum()) - np.repeat(np.cumsum(wide) - wide, wide)
            docs.append(holder[np.repeat(first[at], wide) + inner])
            keys.append(np.repeat((count.astype(_U) << _U(_TOKEN_BITS)) | _from_planes(planes), wide))
        doc = np.concatenate(docs) if docs else np.zeros(0, np.uint16)
        key = np.concatenate(keys) if keys else np.zeros(0, _U)
        order = np.lexsort((key, doc))
        doc, key = doc[order], key[order]
        cuts = np.searchsorted(doc, np.arange(len(n) + 1))
        enough = np.zeros(len(n), dtype=bool)
        enough[head["own"]] = True
        enough &= (np.diff(cuts) >= least_overlap(n, percent)) & (n > 0)
        blobs = [key[cuts[i] : cuts[i + 1]].tobytes() if enough[i] else None for i in range(len(n))]
        del doc, key, docs, keys, order, holder
        trim_memory()
        return pa.table({
            "doc_id": pa.array(head["ids"], pa.int64(), mask=head["id_null"]), "n": pa.array(n), "key1": pa.array(head["key1"].view(np.int64)), "key2": pa.array(head["key2"].view(np.int64)), "ranked": pa.array(blobs, pa.binary()),
        })

    return join


def ranked_sets(docs: DataFrame, percent: int = 75) -> DataFrame:
    """doc_id, n (shingles), key1 and key2 (the word sequence's hash), and ranked: the repeated shingles of texts that may have
    partners, rarest first, as unsigned 64-bit integers (documents that hold it, then its hash).  Every shingle is counted."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(LEAST_BUCKETS, -(-size // (SHINGLE_BYTES * BUCKET_SHINGLES)))
    sent = with_small_batches(docs).select(F.col("doc_id").cast("long"), "text").mapInArrow(_block_sender(buckets), _BLOCK_SCHEMA)
    counted = sent.groupBy("bucket").applyInArrow(_count_bucket, _BLOCK_SCHEMA)
    return staged(counted.groupBy("block").applyInArrow(_block_joiner(percent), "doc_id long, n long, key1 long, key2 long, ranked binary"), "ranked")


def _prefix_sender(percent: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, token = [], []
            for rep, n, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                keys = np.frombuffer(raw.as_py(), dtype=_U)
                own = keys[: _prefix(n, len(keys), percent)]
                token.append(own)
                node.append(np.full(len(own), rep, np.int64))
            if node:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(token).view(np.int64)), pa.array(np.concatenate(node))], ["token", "node"])

    return send


def _prefix(n: int, repeated: int, percent: int) -> int:
    """Repeated shingles in the prefix: those of one document alone stand before them."""
    return n - int(least_overlap(n, percent)) + 1 - (n - repeated)


class _Sets:
    """Union-find over the texts of a cluster."""

    def __init__(self, n: int, known: np.ndarray | None = None) -> None:
        self.up = np.arange(n)
        if known is not None:
            _, first, of = np.unique(known, return_index=True, return_inverse=True)
            self.up = first[of]

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return int(x)

    def roots(self, xs: np.ndarray) -> np.ndarray:
        found = self.up[xs]
        while True:
            above = self.up[found]
            if (above == found).all():
                return found
            found = above


def _overlap(a: np.ndarray, b: np.ndarray) -> int:
    return len(np.intersect1d(a, b, assume_unique=True))


def verified_links(sizes: np.ndarray, ranked: list[np.ndarray], side: np.ndarray | None, percent: int, known: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links that span the components of the texts' link graph.  With side, only pairs of two sides are compared; with known, texts
    of one component are taken as linked."""
    k = len(ranked)
    order = np.lexsort((np.arange(k), sizes))  # short before long: a text looks back at those at least 3/4 as long
    rank = np.empty(k, np.int64)
    rank[order] = np.arange(k)
    n = sizes[order]
    sets = [ranked[i] for i in order]
    lengths = np.array([len(x) for x in sets])
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(k), lengths)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    by_key = np.argsort(flat, kind="stable")
    keys, starts = np.unique(flat[by_key], return_index=True)
    stops = np.append(starts[1:], len(flat))
    id_of = np.searchsorted(keys, flat)
    posted, posted_place = owner[by_key], place[by_key]
    alone = n - lengths  # shingles that no other text has
    cuts = np.searchsorted(keys, keys[(len(keys) * np.arange(1, 8)) // 8]) if len(keys) >= 64 else np.zeros(0, np.int64)
    parts = np.zeros((k, len(cuts) + 1), np.int64)
    np.add.at(parts, (owner, np.searchsorted(cuts, id_of, "right")), 1)
    sides = side[order] if side is not None else None
    groups, links = _Sets(k, known[order] if known is not None else None), []
    first = np.cumsum(lengths) - lengths
    for a in range(1, k):
        own = id_of[first[a] : first[a] + lengths[a]]
        take = _prefix(int(n[a]), int(lengths[a]), percent)
        found, mine, theirs = [], [], []
        for p, t in enumerate(own[:take].tolist()):
            s, e = starts[t], stops[t]
            e = s + int(np.searchsorted(posted[s:e], a))
            if e > s:
                found.append(posted[s:e])
                theirs.append(posted_place[s:e])
                mine.append(np.full(e - s, p))
        if not found:
            continue
        b, at = np.unique(np.concatenate(found), return_index=True)  # the first shared shingle of each
        pos_a, pos_b = np.concatenate(mine)[at], np.concatenate(theirs)[at]
        in_prefix = pos_b < n[b] - least_overlap(n[b], percent) + 1 - alone[b]
        need = -(-percent * (n[a] + n[b]) // (100 + percent))
        keep = in_prefix & (n[b] >= least_overlap(int(n[a]), percent))  # length
        keep &= np.minimum(lengths[a] - pos_a, lengths[b] - pos_b) >= need  # positional
        keep &= alone[a] + alone[b] + np.abs(parts[b] - parts[a]).sum(axis=1) <= n[a] + n[b] - 2 * need  # suffix: symmetric difference by part
        if sides is not None:
            keep &= sides[b] != sides[a]
        b = b[keep]
        if len(b):
            b = b[groups.roots(b) != groups.root(a)]
        if not len(b):
            continue
        if len(b) <= 6:
            common = np.array([_overlap(sets[a], sets[x]) for x in b])
        else:
            common = np.bincount(np.concatenate([posted[starts[t] : stops[t]] for t in own.tolist()]), minlength=k)[b]
        for x in b[100 * common >= percent * (n[a] + n[b] - common)].tolist():
            one, two = groups.root(a), groups.root(x)
            if one != two:
                groups.up[max(one, two)] = min(one, two)
                links.append((int(order[a]), int(order[x])))
    return links


def _verifier(percent: int):
    def verify(rows):
        keys = [rows.column(c).to_numpy() for c in ("root", "side", "chunk")]
        node, n, visits, known = (rows.column(c).to_numpy() for c in ("node", "n", "visits", "known"))
        blobs = rows.column("ranked").combine_chunks()
        order = np.lexsort((node, *keys))
        change = np.zeros(len(order), dtype=bool)
        change[:1] = True
        for key in keys:
            change[1:] |= np.diff(key[order]) != 0
        cut = np.flatnonzero(change)
        us, vs = [], []
        for s, e in zip(cut.tolist(), [*cut[1:].tolist(), len(order)]):
            own = order[s:e]
            if len(own) > 1:
                sets = [np.frombuffer(blobs[int(i)].as_py(), dtype=_U) for i in own]
                crossing = keys[2][own[0]] >= 0  # visitors against residents; else all against all
                for a, b in verified_links(n[own], sets, visits[own] if crossing else None, percent, known[own] if crossing else None):
                    us.append(int(node[own[a]]))
                    vs.append(int(node[own[b]]))
        return pa.table({"u": pa.array(us, pa.int64()), "v": pa.array(vs, pa.int64())})

    return verify


_TASK_COLUMNS = ("root", "side", "chunk", "node", "n", "visits", "known", "ranked")


def _links(rows: DataFrame, tasks: int, percent: int, tag: str) -> DataFrame:
    dealt = rows.select(*_TASK_COLUMNS).withColumn("task", F.pmod(F.xxhash64("root", "side", "chunk"), F.lit(tasks)))
    return staged(dealt.groupBy("task").applyInArrow(_verifier(percent), "u long, v long"), tag)


def _visits(postings: DataFrame, sided: DataFrame, roots: DataFrame) -> DataFrame:
    """node, root and side of the texts that have candidates in a side that is not theirs; see (5) above."""
    where = sided.filter("sides > 1").join(roots.select("node", F.col("root").alias("known")), "node", "left").withColumn("known", F.coalesce("known", "node"))
    members = staged(postings.join(where.select("node", "root", "side", "known"), "node"), "members")
    by_known = members.groupBy("token", "known").agg(F.count("*").alias("c"))
    tokens = by_known.groupBy("token").agg(F.max_by("known", F.struct("c", "known")).alias("largest"), F.count("*").alias("components"), F.sum("c").alias("k")).filter("components > 1").drop("components")
    moving = spread_join(members, tokens, "token", members.count()).filter("known <> largest").select("token", "node", "root", F.col("side").alias("own"), "known")
    sides = members.groupBy("token", "side").agg(F.min("known").alias("low"), F.max("known").alias("high"))
    return moving.join(sides, "token").filter("side <> own and not (low = known and high = known)").select("node", "root", "side", "known").distinct()


def link_components(ranked: DataFrame, percent: int = 75) -> DataFrame:
    """node (the smallest doc_id of a word sequence) and root (the smallest of its component) of all texts that have links."""
    texts = staged(
        ranked.filter("n > 0").groupBy("key1", "key2").agg(F.min("doc_id").alias("node"), F.max("n").alias("n"), F.first("ranked", ignorenulls=True).alias("ranked")).filter("ranked is not null and node is not null").select("node", "n", "ranked"),
        "texts",
    )
    postings = staged(texts.mapInArrow(_prefix_sender(percent), "token long, node long"), "postings")
    leaders = staged(postings.groupBy("token").agg(F.min("node").alias("leader"), F.count("*").alias("k")).filter("k > 1"), "leaders")
    near = spread_join(postings, leaders, "token", postings.count()).filter("node <> leader").select(F.col("node").alias("u"), F.col("leader").alias("v")).distinct()
    clusters = staged(connected_components(near), "clusters")
    many = clusters.count()
    sizes = clusters.groupBy("root").agg(F.ceil(F.count("*") / CLUSTER_TEXTS).cast("int").alias("sides"), F.count("*").alias("k"))
    sided = staged(spread_join(clusters, sizes, "root", many).withColumn("side", F.pmod(F.xxhash64("node"), F.col("sides")).cast("int")), "sided")
    home = texts.join(sided, "node").withColumns({"chunk": F.lit(-1), "visits": F.lit(0), "known": F.col("node")})
    # the first text of a cluster is verified in all its sides: where it has copies, these become one component
    first = home.filter("node = root and sides > 1").withColumns({"own": F.col("side"), "side": F.explode(F.sequence(F.lit(0), F.col("sides") - 1))}).filter("side <> own")
    tasks = max(24, -(-many // 500))
    links = _links(home.select(*_TASK_COLUMNS).unionByName(first.select(*_TASK_COLUMNS)), tasks, percent, "links")
    roots = staged(connected_components(links), "components")
    if sided.filter("sides > 1").isEmpty():
        return roots
    visits = staged(_visits(postings, sided, roots), "visits")
    chunks = staged(visits.groupBy("root", "side").agg(F.ceil(F.count("*") / CLUSTER_TEXTS).cast("int").alias("chunks")), "chunks")
    known = sided.join(roots.select("node", F.col("root").alias("known")), "node", "left").select("node", "root", "side", F.coalesce("known", "node").alias("known"))
    placed = known.join(chunks, ["root", "side"]).select("node", "root", "side", "known", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), F.lit(0).alias("visits"))
    guests = visits.join(chunks, ["root", "side"]).select("node", "root", "side", "known", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int").alias("chunk"), F.lit(1).alias("visits"))
    crossing = _links(texts.join(placed.unionByName(guests), "node"), max(tasks, -(-chunks.agg(F.coalesce(F.sum("chunks"), F.lit(0))).first()[0])), percent, "crossing")
    return staged(connected_components(links.unionByName(crossing)), "components")


def ngram_components(docs: DataFrame, percent: int = 75) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest doc_id reachable by links) of every document."""
    ranked = ranked_sets(docs, percent)
    roots = link_components(ranked, percent)
    some = ranked.filter("n > 0").select("doc_id", "n", "key1", "key2")
    nodes = some.groupBy("key1", "key2").agg(F.min("doc_id").alias("node"), F.count("*").alias("k")).join(roots, "node", "left")
    placed = spread_join(some, nodes, ["key1", "key2"], some.count())  # many copies of a text are rows of one key
    linked = placed.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("root", "node").alias("component_id"))
    return linked.unionByName(ranked.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))
