"""Search: every word of the query as a literal part of some field, with filters by the hierarchy of source paths."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardloom.schema import SEARCH_FIELDS, SOURCE_KEY

PAGE = 200
PAGE_OF_PART = 500


def query_words(query: str | None) -> list[str]:
    return (query or "").lower().split()


def matches(query: str | None, fields: tuple[str, ...] = SEARCH_FIELDS) -> Column:
    """Words have no white space, so each lies within one field; wildcards have no meaning."""
    haystack = F.lower(F.concat_ws(" ", *[F.coalesce(F.col(f).cast("string"), F.lit("")) for f in fields]))
    return reduce(lambda a, b: a & b, [F.contains(haystack, F.lit(w)) for w in query_words(query)], F.lit(True))


def _assembly_name(ac: str | None, constituency: str) -> Column:
    """Whether the constituency holds the name of an assembly given as number and name; false if it is not given so."""
    found = re.match(r"\d+_(.*\S.*)", (ac or "").strip().replace(" ", "_"))
    if not found:
        return F.lit(False)
    name, held = found[1].strip().lower(), F.lower(F.coalesce(F.col(constituency), F.lit("")))
    return held.contains(name.replace("_", " ").strip()) | held.contains(name)


def district_filter(district: str, ac: str | None = None, constituency: str = "constituency", path: str = SOURCE_KEY) -> Column:
    """Paths that start with the district, as given, with spaces or with underscores.  A bare file name has no district in it: it
    passes only if the assembly asked for is that of its constituency, so never without one."""
    given, p = district.strip(), F.coalesce(F.col(path), F.lit(""))
    starts = p.startswith(f"{given}/") | p.startswith(f"{given.replace(' ', '_')}/") | p.startswith(f"{given.replace('_', ' ')}/")
    return starts | (~p.contains("/") & _assembly_name(ac, constituency))


def assembly_filter(ac: str, constituency: str = "constituency", path: str = SOURCE_KEY) -> Column:
    """ac: number and name, with underscores or spaces."""
    folder = ac.strip().replace(" ", "_")
    return F.coalesce(F.col(path), F.lit("")).contains(f"/{folder}/") | _assembly_name(ac, constituency)


def assembly_number_filter(number: int, path: str = SOURCE_KEY) -> Column:
    return F.coalesce(F.col(path), F.lit("")).contains(f"/{number}_")


def part_filter(number: int, part: str = "partNo", path: str = SOURCE_KEY) -> Column:
    p = F.coalesce(F.col(path), F.lit(""))
    return p.endswith(f"/part_{number}.pdf") | (p == f"part_{number}.pdf") | F.coalesce(F.col(part) == number, F.lit(False))


def worth_asking(query: str | None, *filters: object) -> bool:
    """An interactive search asks only with a filter or with two characters at least."""
    return any(f is not None and f != "" for f in filters) or len((query or "").strip()) >= 2


def search(registry: DataFrame, query: str | None = "", district: str | None = None, ac: str | None = None, assembly: int | None = None, part: int | None = None, limit: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(all matches, their first page in a fixed order).  No query and no filter match nothing; a filter alone is enough."""
    filters = []
    if district:
        filters.append(district_filter(district, ac))
    if ac:
        filters.append(assembly_filter(ac))
    elif assembly is not None:
        filters.append(assembly_number_filter(assembly))
    if part is not None:
        filters.append(part_filter(part))
    if not filters and not query_words(query):
        found = registry.limit(0)
    else:
        found = registry.filter(reduce(lambda a, b: a & b, filters, matches(query)))
    order = [F.col(SOURCE_KEY), F.col("page"), F.col("serialNo").isNull(), F.col("serialNo"), *[F.col(c) for c in registry.columns if c not in (SOURCE_KEY, "page", "serialNo")]]
    return found, found.orderBy(*order).limit(limit or (PAGE if part is None else PAGE_OF_PART))
