"""Pages as pixels: profiles, the card grid with its occupied cells, boxes of connected dark pixels, and row strips.

A page is one row with its image as bytes; no pixel becomes a row.  Python looks at pixels only where a count of them is needed (one Arrow
pass for the profiles, one for the ink of cells, one for connected components); lines, frames, dividers, cells, page classes and the
suppression of double boxes are array expressions between these passes, so that a page goes from its bytes to its cards in one stage,
without a shuffle.  A page that cannot be decoded has its error in a column and null results."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from cardloom.operators import geometry as G
from cardloom.operators.strips import pastes, strip_cards
from cardloom.schema import LAYOUT, Layout

#: A pixel belongs to a line below DARK, and counts as ink below INK.
DARK, INK = 120, 140
#: Shares of the page's height or width from which a profile counts as a line, and the gap within one: columns of the frame, rows, and
#: the strong columns of a full page.
COLUMN_LINE, ROW_LINE, STRONG_LINE = (0.12, 6), (0.40, 4), (0.18, 6)
#: Lines count as dividers of rows up to so far outside the frame, and as one within the gap.
DIVIDER_REACH, DIVIDER_GAP = 8, 20
#: Local threshold: side and standard deviation of the Gaussian window, and how much darker than its mean a pixel has to be.
WINDOW, SIGMA, DARKER = 31, 5.0, 8
#: Width and height of the rectangle that closes gaps, and how often it does.
CLOSING, CLOSINGS = (9, 7), 2

Decoder = Callable[[bytes], np.ndarray]
BOX = "struct<x:int,y:int,w:int,h:int>"


def decoded(content: bytes) -> np.ndarray:
    """Grey values (rows x columns) of a binary portable graymap or pixmap with 8 bits a sample."""
    fields, at = [], 0
    while len(fields) < 4:
        while content[at : at + 1].isspace():
            at += 1
        if content[at : at + 1] == b"#":
            at = content.index(b"\n", at)
            continue
        stop = at
        while stop < len(content) and not content[stop : stop + 1].isspace():
            stop += 1
        if stop == at:
            raise ValueError("the image ends in its header")
        fields.append(content[at:stop])
        at = stop
    kind, width, height, most = fields[0], *map(int, fields[1:])
    if kind not in (b"P5", b"P6") or not 0 < most < 256:
        raise ValueError("the image is no 8-bit graymap or pixmap")
    samples = 1 if kind == b"P5" else 3
    grey = np.frombuffer(content, np.uint8, width * height * samples, at + 1).reshape(height, width, samples)
    if samples == 3:
        grey = (grey.astype(np.uint32) @ np.array([4899, 9617, 1868], np.uint32) + (1 << 13) >> 14).astype(np.uint8)[..., None]
    return grey[..., 0]


#: Pages whose results are passed on together: so many at most, and so many bytes of them (a larger page is alone).
LOOKED = (512, 4 << 20)


def _parts(batch: pa.RecordBatch, most: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    """A batch in pieces of bounded rows and bytes of content."""
    sizes = pc.fill_null(pc.binary_length(batch.column("content")), 0).to_pylist()
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if i > start and (i - start == most[0] or held + size > most[1]):
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if sizes:
        yield batch.slice(start)


def _array(values: tuple, kind: pa.DataType) -> pa.Array:
    """An Arrow array of values; lists of numbers may be NumPy arrays."""
    if not pa.types.is_list(kind) or not any(isinstance(v, np.ndarray) for v in values):
        return pa.array(values, kind)
    ends = np.cumsum([0, *(0 if v is None else len(v) for v in values)])
    flat = np.concatenate([v for v in values if v is not None])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32(), mask=np.array([*(v is None for v in values), False])), pa.array(flat, kind.value_type))


def _each_page(pages: DataFrame, keep: list[str], take: list[str], names: list[str], shape: str, look: Callable, decode: Decoder) -> DataFrame:
    """pages with the columns that look(grey, *values of take) gives, and error.  Pages are looked at one at a time."""
    kinds = pages.select(*keep).schema
    whole = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kinds) + f", {shape}, error string"
    out_names = [*keep, *names, "error"]

    arrow = to_arrow_schema(T.StructType.fromDDL(whole))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch, LOOKED):
                seen, errors = [], []
                for content, *values in zip(*(part.column(n) for n in ("content", *take))):
                    try:
                        found, error = look(decode(content.as_py()), *(v.as_py() for v in values)), None
                    except Exception as e:  # noqa: BLE001  whatever is wrong with one page concerns that page
                        found, error = (None,) * len(names), f"{type(e).__name__}: {e}"
                    seen.append(found)
                    errors.append(error)
                columns = [*[part.column(n).cast(arrow.field(n).type) for n in keep], *[_array(v, arrow.field(n).type) for n, v in zip(names, zip(*seen))], pa.array(errors, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, out_names)

    need = list(dict.fromkeys([*keep, "content", *take]))
    return pages.select(*need).mapInArrow(run, whole)


def _profiles(grey: np.ndarray) -> tuple:
    dark = grey < DARK
    return grey.shape[1], grey.shape[0], float((grey < INK).mean()) if grey.size else 0.0, np.count_nonzero(dark, axis=0), np.count_nonzero(dark, axis=1)


def profiled(pages: DataFrame, decode: Decoder = decoded) -> DataFrame:
    """pages (content and key columns) with page_w, page_h, ink (share of pixels), column_dark and row_dark (counts), and error."""
    names = ["page_w", "page_h", "ink", "column_dark", "row_dark"]
    return _each_page(pages, pages.columns, [], names, "page_w int, page_h int, ink double, column_dark array<int>, row_dark array<int>", _profiles, decode)


def lined(pages: DataFrame, layout: Layout = LAYOUT) -> DataFrame:
    """Profiled pages with their lines (column_lines, row_lines, strong_columns), frame, dividers of rows and cells of the grid."""
    line = lambda c, side, rule: G.peak_positions(F.col(c), F.col(side) * rule[0], rule[1])
    out = pages.withColumns({"column_lines": line("column_dark", "page_h", COLUMN_LINE), "row_lines": line("row_dark", "page_w", ROW_LINE), "strong_columns": F.size(line("column_dark", "page_h", STRONG_LINE))})
    out = out.withColumn("frame", F.when(F.col("page_w").isNotNull(), G.content_frame(F.col("column_lines"), F.col("row_lines"), F.col("page_w"), F.col("page_h"), layout)))
    top, height = F.col("frame.y"), F.col("frame.h")
    inner = F.filter("row_lines", lambda y: (y >= top - DIVIDER_REACH) & (y <= top + height + DIVIDER_REACH))
    out = out.withColumn("dividers", G.row_dividers(G.cluster_medians(inner, DIVIDER_GAP), top, height, layout.rows))
    cells = G.cell_boxes(F.col("frame.x"), F.col("frame.w"), F.col("dividers"), F.col("page_w"), F.col("page_h"), layout)
    return out.withColumn("cells", F.when(F.col("page_w").isNotNull(), cells))


def _cell_ink(margin: int) -> Callable:
    def look(grey: np.ndarray, cells: list[dict]) -> tuple[list[float]]:
        out = []
        for c in cells:
            crop = grey[c["cell_y"] : c["cell_y"] + c["cell_h"], c["cell_x"] : c["cell_x"] + c["cell_w"]]
            if margin and min(crop.shape) > 2 * margin:
                crop = crop[margin:-margin, margin:-margin]
            out.append(float((crop < INK).mean()) if crop.size else 0.0)
        return (out,)

    return look


def grid_cards(pages: DataFrame, key: list[str], layout: Layout = LAYOUT, decode: Decoder = decoded) -> DataFrame:
    """key, page_w, page_h, ink, column_lines, row_lines, strong_columns, frame, cells (array of structs with card_index, x, y, w, h, ink
    and occupied) and error of every page.  The ink of a cell is that of its inner part, a margin inside its edges where it is large enough."""
    flat = lined(profiled(pages.select(*key, "content"), decode), layout).drop("column_dark", "row_dark", "dividers").withColumnRenamed("error", "_error")
    inked = _each_page(flat, [c for c in flat.columns if c != "content"], ["cells"], ["cell_ink"], "cell_ink array<double>", _cell_ink(layout.probe_margin), decode)
    cell = lambda c, ink: F.struct(c["card_index"].alias("card_index"), *[c[f"cell_{s}"].cast("int").alias(s) for s in "xywh"], ink.alias("ink"), G.occupied(ink, layout).alias("occupied"))
    return inked.withColumn("cells", F.zip_with("cells", "cell_ink", cell)).withColumn("error", F.coalesce("_error", "error")).drop("cell_ink", "_error")


#: The local threshold looks at single pixels while those that it needs are at most this share of the page.
SPARSE = 0.2


def local_dark(grey: np.ndarray) -> np.ndarray:
    """Pixels darker than the mean of their neighbourhood (Gaussian, edges repeated) by at least so much.  No mean is above the page's
    lightest pixel, so only pixels darker than that one can be dark; where they are few, means are computed at them alone, by the same sums."""
    half = WINDOW // 2
    weights = np.exp(-np.square(np.arange(-half, half + 1)) / (2 * SIGMA * SIGMA))
    weights = (weights / weights.sum()).astype(np.float32)
    dark = np.zeros(grey.shape, bool)
    if not grey.size or (lightest := int(grey.max())) < DARKER:
        return dark
    rows = np.flatnonzero((grey <= lightest - DARKER).any(axis=1))
    may = grey[rows] <= lightest - DARKER
    near = _stretched(may, WINDOW, 1)  # the mean along columns is needed here, the one along rows at the pixels that may be dark
    if np.count_nonzero(near) > SPARSE * grey.size:
        return grey.astype(np.int16) <= np.rint(_means(grey, weights)).astype(np.int16) - DARKER
    width = grey.shape[1]

    def summed(values: np.ndarray, at: np.ndarray, step: int) -> np.ndarray:
        """at: the first place of each window."""
        mean = weights[half] * values[half * step :].take(at)
        for i in range(half):
            mean += weights[i] * (values[i * step :].take(at) + values[(2 * half - i) * step :].take(at)).astype(np.float32, copy=False)
        return mean

    padded = np.empty((grey.shape[0] + 2 * half, width), np.uint16)
    padded[half:-half], padded[:half], padded[-half:] = grey, grey[0], grey[-1]
    row, column = np.divmod(np.flatnonzero(near), width)
    means = np.zeros((len(rows), width + 2 * half), np.float32)
    means[row, column + half] = summed(padded.ravel(), rows[row] * width + column, width)
    means[:, :half], means[:, -half:] = means[:, half : half + 1], means[:, -half - 1 : -half]
    row, column = np.divmod(np.flatnonzero(may), width)
    mean = summed(means.ravel(), row * (width + 2 * half) + column, 1)
    dark[rows[row], column] = grey[rows[row], column].astype(np.int16) <= np.rint(mean).astype(np.int16) - DARKER
    return dark


def _means(grey: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The weighted mean around every pixel, along columns and then along rows."""
    half, mean = WINDOW // 2, grey.astype(np.float32)
    for axis in (0, 1):
        padded = np.pad(mean, [(half, half) if a == axis else (0, 0) for a in (0, 1)], mode="edge")
        size = mean.shape[axis]
        cut = lambda i: padded[i : i + size] if axis == 0 else padded[:, i : i + size]  # noqa: B023, E731
        mean = weights[half] * cut(half)
        for i in range(half):
            mean += weights[i] * (cut(i) + cut(2 * half - i))
    return mean


def _stretched(mask: np.ndarray, wide: int, high: int) -> np.ndarray:
    """Whether a pixel of the mask lies in the window (of odd sides) around each pixel: runs of doubled length, one on the other."""
    for axis, side in ((0, high), (1, wide)):
        if side == 1 or not mask.size:
            continue
        half, size = side // 2, mask.shape[axis]
        run = np.pad(mask, [(half, half) if a == axis else (0, 0) for a in (0, 1)])
        cut = lambda x, start, stop: x[start:stop] if axis == 0 else x[:, start:stop]  # noqa: B023, E731
        length = 1  # run[i]: of the padded pixels i to i + length - 1 one is set
        while length < side:
            step = min(length, side - length)
            run = cut(run, 0, run.shape[axis] - step) | cut(run, step, run.shape[axis])
            length += step
        mask = cut(run, 0, size)
    return mask


def closed(mask: np.ndarray, rectangle: tuple[int, int] = CLOSING, times: int = CLOSINGS) -> np.ndarray:
    """Morphological closing by a rectangle, so often: dilations, then as many erosions.  What lies outside the image has no say."""
    wide, high = ((side - 1) * times + 1 for side in rectangle)
    out = np.zeros_like(mask)
    rows, columns = np.flatnonzero(mask.any(axis=1)), np.flatnonzero(mask.any(axis=0))
    if len(rows):  # nothing grows beyond its own window, nor shrinks by what is beyond two
        part = np.s_[max(rows[0] - 2 * high, 0) : rows[-1] + 2 * high + 1, max(columns[0] - 2 * wide, 0) : columns[-1] + 2 * wide + 1]
        out[part] = ~_stretched(~_stretched(mask[part], wide, high), wide, high)
    return out


def component_boxes(mask: np.ndarray, diagonal: bool = True) -> np.ndarray:
    """x, y, w, h of the connected components of a mask, in order of their first pixel.  Runs of each row are joined to those they touch in
    the row above; components are found by hooking labels to the smallest and shortening paths, over runs and not pixels."""
    height, width = mask.shape
    padded = np.pad(mask, [(0, 0), (1, 1)])
    row, edge = np.divmod(np.flatnonzero(padded[:, 1:] != padded[:, :-1]), width + 1)
    row, start, stop = row[::2], edge[::2], edge[1::2]  # every row begins and ends outside: its edges are starts and stops (exclusive) in turn
    if not len(row):
        return np.zeros((0, 4), np.int64)
    reach = 1 if diagonal else 0
    span = width + 2  # place of a run on a line on which rows follow each other
    lines = row.astype(np.int64) * span
    first = np.searchsorted(lines + stop, lines - span + start + (1 - reach), "left")  # of the row above: those that do not end before
    last = np.searchsorted(lines + start, lines - span + stop - 1 + reach, "right")  # and do not start after
    first = np.maximum(first, np.searchsorted(row, row - 1, "left"))
    last = np.minimum(last, np.searchsorted(row, row - 1, "right"))
    many = np.maximum(last - first, 0)
    below = np.repeat(np.arange(len(row)), many)
    above = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(first, many)
    label = np.arange(len(row))
    while True:
        a, b = label[above], label[below]
        if (a == b).all():
            break
        low, high = np.minimum(a, b), np.maximum(a, b)
        np.minimum.at(label, high, low)
        while not (label == (short := label[label])).all():
            label = short
    roots, own = np.unique(label, return_inverse=True)
    boxes = np.empty((len(roots), 4), np.int64)
    low = np.full((2, len(roots)), np.iinfo(np.int64).max)
    high = np.full((2, len(roots)), -1)
    for axis, (a, b) in enumerate(((start, stop), (row, row + 1))):
        np.minimum.at(low[axis], own, a)
        np.maximum.at(high[axis], own, b)
    boxes[:, :2], boxes[:, 2:] = low.T, (high - low).T
    return boxes


def outline_boxes(mask: np.ndarray) -> np.ndarray:
    """Boxes of all outlines: of the components (diagonals connect), and of the holes in them with the pixels around them."""
    height, width = mask.shape
    holes = component_boxes(~np.pad(mask, 1), diagonal=False) - [1, 1, 0, 0]
    inner = (holes[:, 0] > 0) & (holes[:, 1] > 0) & (holes[:, 0] + holes[:, 2] < width) & (holes[:, 1] + holes[:, 3] < height)
    return np.concatenate([component_boxes(mask), holes[inner] + [-1, -1, 2, 2]])


def _outlines(grey: np.ndarray) -> tuple:
    return grey.shape[1], grey.shape[0], [dict(zip("xywh", b)) for b in outline_boxes(closed(local_dark(grey))).tolist()]


def contour_cards(pages: DataFrame, key: list[str], layout: Layout = LAYOUT, decode: Decoder = decoded) -> DataFrame:
    """key, cards (array of boxes in reading order) and error: cards by the outlines of what is dark on each page.  Outlines of a card's size
    are kept, double ones are suppressed, and what is left has to have a card's shape."""
    flat = _each_page(pages, key, [], ["page_w", "page_h", "outlines"], f"page_w int, page_h int, outlines array<{BOX}>", _outlines, decode)
    w, h = F.col("page_w"), F.col("page_h")
    sized = F.filter("outlines", lambda b: G.contour_sized(b["w"], b["h"], w, h))
    return flat.select(*key, F.filter(G.suppressed(sized), lambda b: G.card_shaped(b["w"], b["h"], w, h, layout)).alias("cards"), "error")


def detected(pages: DataFrame, key: list[str], layout: Layout = LAYOUT, decode: Decoder = decoded) -> DataFrame:
    """key, page_type, method, cards (array of structs with card_index, x, y, w, h) and error of every page: the grid's occupied cells, or the
    outlines where the grid is empty or misses more than a few."""
    grid = grid_cards(pages, key, layout, decode).withColumnRenamed("error", "_grid_error")
    keyed = pages.select(*key, "content")
    # both look at the same bytes: outlines join by key, whose rows are small by then
    outlines = contour_cards(keyed, key, layout, decode).withColumnRenamed("cards", "outlines")
    met = grid.join(outlines, key)
    occupied = F.filter("cells", lambda c: c["occupied"])
    many = F.size(occupied)
    method = G.detector(many, F.size("outlines"), layout)
    box = lambda c, i: F.struct(i.cast("int").alias("card_index"), *[c[s].alias(s) for s in "xywh"])
    cards = F.when(method == "contour", F.transform("outlines", box)).otherwise(F.transform(occupied, lambda c: box(c, c["card_index"])))
    kind = G.page_class(F.col("ink"), F.size("outlines"), F.col("strong_columns"), F.size("row_lines"), many, layout)
    read = F.col("page_w").isNotNull()
    return met.select(*key, F.when(read, kind).alias("page_type"), F.when(read, method).alias("method"), F.when(read, cards).alias("cards"), F.coalesce("_grid_error", "error").alias("error"))


def strip_images(pages: DataFrame, cards: DataFrame, key: list[str], layout: Layout = LAYOUT, decode: Decoder = decoded) -> DataFrame:
    """key, row, w, h, grey (bytes, row by row) of the strip of every row of cards: white, but for what is pasted from the page."""
    placed = strip_cards(cards, *key, columns=layout.columns)
    rows = placed.groupBy(*key, "row").agg(F.first("strip_w").alias("w"), F.first("strip_h").alias("h"), F.sort_array(F.collect_list(F.struct("card_index", "dx", "dy", F.col("w").alias("cw"), F.col("h").alias("ch")))).alias("cards"))
    parts = pastes(cards, *key, layout=layout).groupBy(*key, "row").agg(F.sort_array(F.collect_list(F.struct("card_index", "src_x", "src_y", "dst_x", "dst_y", "w", "h"))).alias("parts"))
    strips = rows.join(parts, [*key, "row"], "left").groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("row", "w", "h", "cards", "parts"))).alias("strips"))  # rows of one page: a few dozen boxes

    def look(grey: np.ndarray, strips: list[dict]) -> tuple:
        out = []
        for s in strips:
            image = np.full((s["h"], s["w"]), 255, np.uint8)
            for card in s["cards"]:
                image[card["dy"] : card["dy"] + card["ch"], card["dx"] : card["dx"] + card["cw"]] = 255
                for p in s["parts"] or []:
                    if p["card_index"] == card["card_index"]:
                        part = grey[p["src_y"] : p["src_y"] + p["h"], p["src_x"] : p["src_x"] + p["w"]]
                        image[p["dst_y"] : p["dst_y"] + part.shape[0], p["dst_x"] : p["dst_x"] + part.shape[1]] = part
            out.append({"row": s["row"], "w": s["w"], "h": s["h"], "grey": image.tobytes()})
        return (out,)

    made = _each_page(pages.join(strips, key), key, ["strips"], ["made"], "made array<struct<row:long,w:int,h:int,grey:binary>>", look, decode)
    return made.select(*key, F.explode("made").alias("s")).select(*key, "s.*")
