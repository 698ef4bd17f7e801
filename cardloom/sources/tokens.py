"""Where tokens come from.  Rendering of pages and recognition of characters stay outside: a source is a function from batches of
page files to batches of tokens, run by mapInPandas after the files are filtered, one source per Python worker."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame

TOKEN_TABLE = "doc string, page int, seq int, text string, confidence double, bbox array<array<double>>, error string"
Source = Callable[[pd.DataFrame], pd.DataFrame]


def tokens_from(pages: DataFrame, make_source: Callable[[], Source]) -> DataFrame:
    """The token table of pages (doc, page, content).  make_source builds the reader once per task; a page that it fails on has
    one token without text, with the error beside it, so that no file stops the job."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        source = make_source()
        for batch in batches:
            for i in range(len(batch)):
                one = batch.iloc[i : i + 1]
                try:
                    yield source(one).assign(error=None)
                except Exception as e:  # noqa: BLE001  whatever a reader raises concerns one page
                    yield pd.DataFrame({"doc": one["doc"].tolist(), "page": one["page"].tolist(), "seq": [0], "text": [None], "confidence": [0.0], "bbox": [None], "error": [f"{type(e).__name__}: {e}"]})

    return pages.mapInPandas(read, TOKEN_TABLE)


def text_card_source() -> Source:
    """A source for synthetic pages: each line of the content is 'x y text', as a token 40 wide and 12 high."""

    def source(page: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for doc, number, content in zip(page["doc"], page["page"], page["content"]):
            for seq, line in enumerate(bytes(content).decode().splitlines()):
                x, y, text = line.split(" ", 2)
                x0, y0 = float(x), float(y)
                rows.append((doc, number, seq, text, 0.99, [[x0, y0], [x0 + 40, y0], [x0 + 40, y0 + 12], [x0, y0 + 12]]))
        return pd.DataFrame(rows, columns=["doc", "page", "seq", "text", "confidence", "bbox"])

    return source
