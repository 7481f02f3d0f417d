"""The inverted index of all texts checked so far, kept in pieces.

A batch adds one piece; eight pieces in a row are merged into one, eight merged ones again, so a reader opens a number of
pieces that grows with the logarithm of the batches. Lists are partitioned by ranges of shingles and ordered in
them, sets by number. A piece counts once the table ``index_pieces`` names it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliary.operators.neardup import NearDupSettings
from foliary.operators.probe import list_rows, set_rows

LISTS = "shingle BIGINT, pos INT, seq BIGINT, n INT, p0 BIGINT, p1 BIGINT, p2 BIGINT, p3 BIGINT"
SETS = "seq BIGINT, doc_id STRING, n INT, shingles ARRAY<BIGINT>"
TABLES = {"shingle_lists": (LISTS, "slot"), "shingle_sets": (SETS, "part")}
PIECES = "first BIGINT, last BIGINT, window INT, percent INT"
FAN = 8


def covering(pieces: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The fewest pieces that hold every batch once; pieces nest and never overlap otherwise."""
    out, reached = [], -1
    for first, last in sorted(pieces, key=lambda p: (p[0], -p[1])):
        if first > reached:
            out.append((first, last))
            reached = last
    return out


class StoredIndex:
    """The index of a store (see :class:`foliary.operators.probe.Index`), as of a batch."""

    def __init__(self, store, before: int | None = None):
        self.store = store
        rows = store.read("index_pieces", before).select("first", "last", "window", "percent").collect()
        self.pieces = covering([(r.first, r.last) for r in rows])
        self.laws = {(r.window, r.percent) for r in rows}

    def _folder(self, table: str, piece: tuple[int, int]) -> str:
        return f"{self.store.root}/{table}/piece={piece[0]}-{piece[1]}"

    def _read(self, table: str, pieces: list[tuple[int, int]] | None = None) -> DataFrame:
        columns, key = TABLES[table]
        schema, spark = f"{columns}, piece STRING, {key} INT", self.store.spark
        chosen = self.pieces if pieces is None else pieces
        if not chosen:
            return spark.createDataFrame([], schema).drop("piece")
        paths = [self._folder(table, p) for p in chosen]
        return spark.read.schema(schema).option("basePath", f"{self.store.root}/{table}").parquet(*paths).drop("piece")

    def lists(self, slots: list[int], settings: NearDupSettings) -> DataFrame:
        for window, percent in self.laws:
            if window != settings.window or percent > settings.threshold:
                raise ValueError(f"the index was made for {window} words and {percent} %")
        return self._read("shingle_lists").where(F.col("slot").isin(slots))

    def sets(self, parts: list[int]) -> DataFrame:
        return self._read("shingle_sets").where(F.col("part").isin(parts))

    def rows(self) -> DataFrame:
        """All sets ``(seq, doc_id, n, shingles)``."""
        return self._read("shingle_sets").select("seq", "doc_id", "n", "shingles")

    def _write(self, table: str, piece: tuple[int, int], rows: DataFrame) -> None:
        key = TABLES[table][1]
        order = [key, "shingle" if key == "slot" else "seq"]
        # large slots are split and small ones share a task, however the shingles are spread
        rows.hint("rebalance", key).sortWithinPartitions(*order).write.mode("overwrite").partitionBy(key).parquet(
            self._folder(table, piece))

    def add(self, sets: DataFrame, batch: int, settings: NearDupSettings) -> None:
        """Add the sets of a batch (seq, doc_id, n, shingles); a repeated batch replaces its own piece."""
        known = [] if sets.isEmpty() else [(batch, batch)]
        if known:
            self._write("shingle_sets", known[0], set_rows(sets))
            written = self._read("shingle_sets", known).select("seq", "doc_id", "n", "shingles")
            self._write("shingle_lists", known[0], list_rows(written, "seq", settings))
        made, size = list(known), FAN
        while (batch + 1) % size == 0:  # a run of batches is full: one piece instead
            first = batch + 1 - size
            inside = covering([p for p in [*self.pieces, *made] if p[0] >= first])
            if len(inside) > 1:
                for table in TABLES:
                    self._write(table, (first, batch), self._read(table, inside))
                made.append((first, batch))
            size *= FAN
        rows = [(*p, settings.window, settings.threshold) for p in made]
        self.store.append("index_pieces", self.store.spark.createDataFrame(rows, PIECES), batch)
