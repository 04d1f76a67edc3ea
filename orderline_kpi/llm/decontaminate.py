"""Benchmark decontamination with a distributed positional inverted index.

Test items are cut into windows of consecutive words.  Of each window the ``n_probes`` terms
that are rarest in the documents are looked up; the index holds a posting for every occurrence of
such a term: document, position, and the words around it.  Lists of one window are
moved back by the offset of their term and intersected, the rarest term's being the
shortest; what remains is compared word by word within the posting's own surroundings.  So
the texts are never shuffled: what moves is bounded by how often rare test terms occur.

Terms of the test items reach the documents as broadcast tables of at most
``terms_per_block`` terms; with more terms than that the documents are read once per block.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, Window, functions as F

from orderline_kpi.llm.common import filled
from orderline_kpi.sources.scratch import WorkArea

#: What stands between words once A-Z are lower case, as a Java regular expression.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BETWEEN_ANY_CASE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def terms(text: Column) -> Column:
    """Lower-case words of a text; only A-Z are lowered."""
    lowered = F.translate(filled(text), ascii_uppercase, ascii_lowercase)
    return F.array_remove(F.split(lowered, BETWEEN), "")


def n_terms(text: Column) -> Column:
    return F.size(F.array_remove(F.split(filled(text), BETWEEN_ANY_CASE), "")).cast("long")


def item_windows(items: DataFrame, window: int, id_column: str, text_column: str) -> DataFrame:
    """Each distinct window of the items: ``terms``, and the ``items`` that have it."""
    words = items.select(
        F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("item"), terms(F.col(text_column)).alias("words")
    ).where(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - (window - 1), F.lit(1)))
    return words.select("item", "words", F.explode(starts).alias("start")).select(
        "item", F.slice("words", F.col("start"), F.lit(window)).alias("terms")
    ).groupBy("terms").agg(F.collect_set("item").alias("items"))


def _on_blocks(table: DataFrame, terms_per_block: int, use: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What ``use`` makes of the table's terms, handed over in broadcast blocks."""
    blocks = max(1, -(-table.count() // terms_per_block))
    block = F.pmod(F.xxhash64("term"), F.lit(blocks))
    return reduce(DataFrame.unionByName, [use(F.broadcast(table.where(block == b))) for b in range(blocks)])


def build_index(docs: DataFrame, probe_terms: DataFrame, radius: int, terms_per_block: int) -> DataFrame:
    """Postings of ``probe_terms`` in ``docs`` (id, text_hash, words).

    Returns ``term, id, text_hash, pos`` and ``context``, the words up to ``radius`` to either
    side, among which the term stands at ``at``.
    """
    first = F.greatest(F.col("pos") - radius, F.lit(0))
    return _on_blocks(probe_terms, terms_per_block, lambda block: docs.select(
        "id", "text_hash", "words", F.posexplode("words").alias("pos", "term")
    ).join(block, "term").select(
        "term", "id", "text_hash", "pos", (F.col("pos") - first).alias("at"),
        F.slice("words", first + 1, F.lit(2 * radius + 1)).alias("context"),
    ))


class Decontaminator:
    """The windows of a set of test items and the index of their rarest terms in ``docs``.

    Null texts have no words.  Rows that agree in id and text are one document here and
    share their matches; a null id is an id like any other.  Items with one id are one item.
    """

    def __init__(
        self, docs: DataFrame, items: DataFrame, window: int = 10, n_probes: int = 2, slop: int = 0,
        terms_per_block: int = 200_000, id_column: str = "doc_id", text_column: str = "text",
        item_id_column: str = "item_id", item_text_column: str = "text",
    ) -> None:
        self._work = work = WorkArea(docs.sparkSession, "decontamination")
        self.radius = window - 1 + slop
        self._key = F.col(id_column).alias("id"), F.xxhash64(F.col(text_column)).alias("text_hash")
        self._texts = docs.select(*self._key, F.col(text_column).alias("text"))
        words = self._texts.select("id", "text_hash", terms(F.col("text")).alias("words"))
        windows = work.table(
            item_windows(items, window, item_id_column, item_text_column)
            .withColumn("window_id", F.monotonically_increasing_id()), "windows")
        placed = windows.select("window_id", F.posexplode("terms").alias("offset", "term"))
        counts = work.table(_on_blocks(
            work.table(placed.select("term").distinct(), "terms"), terms_per_block,
            lambda block: words.select(F.explode("words").alias("term")).join(block, "term"),
        ).groupBy("term").agg(F.count(F.lit(1)).alias("n")), "term_counts")
        rarest = Window.partitionBy("window_id").orderBy("n", "offset")
        # A window with a term that no document has cannot occur, and drops out.
        self.probes = work.table(
            placed.join(counts, "term", "left")
            .withColumn("rank", F.row_number().over(rarest))
            .withColumn("least", F.min(F.coalesce("n", F.lit(0))).over(Window.partitionBy("window_id")))
            .where((F.col("rank") <= n_probes) & (F.col("least") > 0))
            .join(windows.drop("items"), "window_id")
            .select("term", "window_id", "offset", "rank", "terms",
                    F.least(F.size("terms"), F.lit(n_probes)).alias("probes")),
            "probes",
        )
        self.windows = windows
        self.index = work.table(build_index(
            words, self.probes.select("term").distinct(), self.radius, terms_per_block), "index")

    def phrase_matches(self) -> DataFrame:
        """``id, text_hash, window_id, start, size`` of each place where a window occurs word by word."""
        exact = F.slice(
            "context", F.greatest(F.col("at") - F.col("offset") + 1, F.lit(1)), F.size("terms")
        ) == F.col("terms")
        lists = self.index.join(self.probes, "term").where(F.col("pos") >= F.col("offset")).select(
            "id", "text_hash", "window_id", (F.col("pos") - F.col("offset")).alias("start"), "rank", "probes",
            F.size("terms").alias("size"), ((F.col("rank") == 1) & exact).alias("exact"),
        )
        return lists.groupBy("id", "text_hash", "window_id", "start", "size", "probes").agg(
            # Rows that are one document have each posting several times.
            F.bit_count(F.bit_or(F.expr("shiftleft(1L, rank)"))).alias("lists"),
            F.bool_or("exact").alias("exact"),
        ).where("lists = probes AND exact").select("id", "text_hash", "window_id", "start", "size")

    def proximity_matches(self) -> DataFrame:
        """``id, text_hash, window_id, pos`` where all terms of a window stand around its rarest one.

        They may come in any order, at most ``window - 1 + slop`` words away from it.
        """
        return self.index.join(self.probes.where("rank = 1"), "term").where(
            F.size(F.array_except("terms", "context")) == 0
        ).select("id", "text_hash", "window_id", "pos").distinct()

    def documents(self) -> DataFrame:
        """Per row of ``docs``: id, ``text_hash``, ``n_words``, ``n_hit``, ``items`` (sorted), ``spans``.

        A word is hit if it lies in any occurrence of a window.  ``spans`` are the matches as
        (start, size), in words.
        """
        found = self.phrase_matches().join(self.windows.select("window_id", "items"), "window_id").groupBy(
            "id", "text_hash"
        ).agg(
            F.sort_array(F.collect_set(F.struct("start", "size"))).alias("spans"),
            F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        )
        hit = F.aggregate(
            "spans", F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
            lambda done, span: F.struct(
                F.greatest(done["end"], span["start"] + span["size"]).alias("end"),
                (done["n"] + F.greatest(
                    span["start"] + span["size"] - F.greatest(done["end"], span["start"]), F.lit(0))).alias("n"),
            ),
            lambda done: done["n"].cast("long"),
        )
        mine = self._texts.select("id", "text_hash", n_terms(F.col("text")).alias("n_words"))
        return mine.alias("d").join(found.alias("f"), (
            F.col("d.id").eqNullSafe(F.col("f.id")) & (F.col("d.text_hash") == F.col("f.text_hash"))), "left"
        ).select(
            "d.id", "d.text_hash", "n_words", F.coalesce(hit, F.lit(0).cast("long")).alias("n_hit"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"), "spans",
        )

    def clean_documents(self, docs: DataFrame, max_share: float = 0.0) -> DataFrame:
        """The rows of ``docs``, those the index was built from, of whose words at most ``max_share`` are hit."""
        hit = self.documents().where(F.col("n_hit") > max_share * F.col("n_words")).select(
            F.col("id").alias("__id"), F.col("text_hash").alias("__hash")).distinct()
        rows = docs.withColumns({"__row_id": self._key[0], "__row_hash": self._key[1]})
        return rows.join(
            hit, F.col("__row_id").eqNullSafe(F.col("__id")) & (F.col("__row_hash") == F.col("__hash")), "left_anti"
        ).select(*docs.columns)
