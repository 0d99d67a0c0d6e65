"""Divergence audit of sources: by which terms a source differs from its language, and sources from one another."""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import bounded, by_bytes, cut, give_back, read, shared_dir

#: A kept term is in so many documents of its language; terms are reported up to this rank.
LEAST_DOCS, TOP = 3, 200
#: The parts that a probability is given in.
PARTS = 1_000_000_000
#: Terms a task counts before it hands on its sums, bytes of a text split at once, pairs of sources weighed at once.
_HELD, _SPLIT, _PAIRS = 400_000, 4 << 20, 1 << 21
#: A-Z become a-z, other ASCII that is no letter a space; bytes beyond ASCII stay.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))


def _pieces(text: bytes) -> Iterator[list[bytes]]:
    a = 0
    text = text.translate(_LETTERS)
    while a < len(text):
        z = text.find(b" ", a + _SPLIT) if len(text) - a > _SPLIT else -1
        z = len(text) if z < 0 else z
        yield text[a:z].split()
        a = z


def group_terms(docs: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """(lang, source, term, n, lang_n, head) of docs(lang, source, text): occurrences of each kept term in a group and in its
    language; head marks one row of each (lang, term). Each group also has a row with the term '' and n 0.

    Null lang, source and text are ''. Terms are runs of letters A-Z, a-z and of anything beyond ASCII, only A-Z lower-cased;
    kept are those in at least least_docs documents (rows) of the language. Repeated rows count again, an empty table has no
    rows, other columns don't matter. Tasks count what they read before anything moves; a term's rows meet twice, first per
    group, where each task brings one row, then per language, with one row for each source.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def out() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, d) in groups.items():
                terms = [b"", *n]
                cols = [pa.array([lang] * len(terms)), pa.array([source] * len(terms)), pa.array(terms, pa.binary()).cast(pa.string()), pa.array([0, *n.values()], pa.int64()), pa.array([0, *map(d.__getitem__, n)], pa.int64())]
                yield pa.RecordBatch.from_arrays(cols, ["lang", "source", "term", "n", "d"])
            groups.clear()

        for b in by_bytes(batches, 2):
            for lang, source, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).cast(pa.binary()).to_pylist(), strict=True):
                n, d = groups.setdefault((lang, source), (Counter(), Counter()))
                seen: set[bytes] = set()
                for words in _pieces(text):
                    n.update(words)
                    seen.update(words)
                d.update(seen)
            if sum(len(n) for n, _ in groups.values()) > _HELD:
                yield from out()
        yield from out()
        give_back()

    texts = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    parts = texts.mapInArrow(count, "lang string, source string, term string, n long, d long")
    each = parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("d").alias("d"))
    term = Window.partitionBy("lang", "term")
    row = each.select("lang", "source", "term", "n", F.sum("d").over(term).alias("docs"), F.sum("n").over(term).alias("lang_n"), (F.row_number().over(term.orderBy("source")) == 1).alias("head"))
    return row.where((F.col("docs") >= least_docs) | (F.col("term") == "")).select("lang", "source", "term", "n", "lang_n", (F.col("head") & (F.col("term") != "")).alias("head"))


def _share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(PARTS * (n + 1) / (total + terms)), exactly; terms is not 0."""
    big = (F.lit(PARTS).cast("decimal(10,0)") * (n + 1).cast("decimal(20,0)")).cast("decimal(38,0)")
    return F.lit(1) + F.call_function("div", big, (total + terms).cast("decimal(20,0)"))


def _apart(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _groups(terms: DataFrame) -> DataFrame:
    """(lang, source, sid, total, lang_total, kept, p0): sums of each group and of its language, p0 the share of a term it lacks."""
    lang, own = Window.partitionBy("lang"), Window.partitionBy("lang").orderBy("source")
    sums = terms.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.sum(F.when(F.col("head"), F.col("lang_n")).otherwise(0)).alias("h"), F.sum(F.col("head").cast("long")).alias("k"))
    out = sums.select("lang", "source", F.row_number().over(own).alias("sid"), "total", F.sum("h").over(lang).alias("lang_total"), F.sum("k").over(lang).alias("kept"))
    return out.withColumn("p0", F.when(F.col("kept") > 0, _share(F.lit(0), F.col("total"), F.col("kept"))))


def divergent_terms(terms: DataFrame, groups: DataFrame, top: int = TOP) -> DataFrame:
    """(lang, source, item, value, rank): the terms that are more frequent in a group than in its language, by value, to rank top.

    All terms with the same count in the group and in the language make one cell with one value. Cells of equal value are
    merged; a value stays while fewer than top terms lie before it, and only the terms of such cells are fetched and ordered.
    """
    key = ["lang", "source"]
    cells = terms.where("n > 0").groupBy(*key, "n", "lang_n").agg(F.count("*").alias("m")).join(bounded(groups), key)
    p, q = _share(F.col("n"), F.col("total"), F.col("kept")), _share(F.col("lang_n"), F.col("lang_total"), F.col("kept"))
    cells = cut(cells.select(*key, "n", "lang_n", "m", p.alias("p"), q.alias("q")).where("p > q").select(*key, "n", "lang_n", "m", _apart(F.col("p"), F.col("q")).alias("value")))
    down = Window.partitionBy(*key).orderBy(F.desc("value"))
    values = cells.groupBy(*key, "value").agg(F.sum("m").alias("m")).withColumn("nth", F.row_number().over(down)).where(F.col("nth") <= top)
    before = F.coalesce(F.sum("m").over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    reach = values.withColumn("before", before).where(F.col("before") < top).groupBy(*key).agg(F.min("value").alias("least"))
    asked = cut(cells.join(bounded(cut(reach)), key).where("value >= least").select(*key, "n", "lang_n", "value"))
    order = Window.partitionBy(*key).orderBy(F.desc("value"), "term")
    rows = terms.where("n > 0").join(bounded(asked), [*key, "n", "lang_n"]).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return rows.select(*key, F.col("term").alias("item"), "value", "rank")


def _joint(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (lang, m, cell array<struct<sid, p, p0>>): per pair of sources, the sum over m terms of each row of what its
    value is above that of terms which one of them, or both, lack."""
    sums: dict[tuple[str, int, int], int] = Counter()

    def f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
        return (p - q) * (p - q) // q

    def out() -> Iterator[pa.RecordBatch]:
        keys = list(sums)
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()), pa.array([k[2] for k in keys], pa.int32()), pa.array(list(sums.values()), pa.int64())], ["lang", "a", "b", "joint"])
        sums.clear()

    for b in batches:
        cell = b.column(2)
        edge, fields = cell.offsets.to_numpy().astype(np.int64), cell.values
        sid, p, p0 = (fields.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3))
        m = b.column(1).to_numpy(zero_copy_only=False)
        names, lang = np.unique(np.array(b.column(0).to_pylist(), object), return_inverse=True)
        row = np.repeat(np.arange(b.num_rows), np.diff(edge))
        left = np.arange(edge[0], edge[-1])
        size = np.diff(edge)[row]
        step = np.cumsum(size) // _PAIRS
        wide = int(sid.max(initial=0)) + 1
        for part in np.split(np.arange(len(left)), np.flatnonzero(np.diff(step)) + 1) if len(left) else []:
            k = size[part]
            x = np.repeat(left[part], k)
            y = np.repeat(edge[row[part]], k) + np.arange(len(x)) - np.repeat(np.cumsum(k) - k, k)
            r = np.repeat(row[part], k)
            x, y, r = x[x != y], y[x != y], r[x != y]
            more = m[r] * (f(p[x], p[y]) - f(p[x], p0[y]) - f(p0[x], p[y]) + f(p0[x], p0[y]))
            code = (lang[r] * wide + sid[x]) * wide + sid[y]
            order = np.argsort(code, kind="stable")
            at = np.flatnonzero(np.diff(code[order], prepend=-1))
            for c, v in zip(code[order][at].tolist(), np.add.reduceat(more[order], at).tolist() if len(at) else [], strict=True):
                sums[names[c // (wide * wide)], c // wide % wide, c % wide] += v
        if len(sums) > 1 << 20:
            yield from out()
    yield from out()


def source_pairs(terms: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value, rank): for each source the others of its language by the sum of their terms' values.

    The sum over all kept terms is taken apart by count cells: all terms as if both sources lacked them, what terms add that
    one has (each count of a source against each other source), and what terms add that both have. For the last, terms with
    the same counts in the same sources are one row, and tasks add up pairs as they go; no row is made for a term and a pair.
    """
    key = ["lang", "source"]
    own = terms.where("n > 0").join(bounded(groups), key).select("lang", "term", "sid", _share(F.col("n"), F.col("total"), F.col("kept")).alias("p"), "p0")
    cells = own.groupBy("lang", "term").agg(F.sort_array(F.collect_list(F.struct("sid", "p", "p0"))).alias("cell")).groupBy("lang", "cell").agg(F.count("*").alias("m"))
    joint = cells.select("lang", "m", "cell").where(F.size("cell") > 1).mapInArrow(_joint, "lang string, a int, b int, joint long").groupBy("lang", "a", "b").agg(F.sum("joint").alias("v"))
    counts = cut(own.groupBy("lang", F.col("sid").alias("s"), "p", F.col("p0").alias("s0")).agg(F.count("*").alias("m")))
    others = bounded(groups.select("lang", F.col("sid").alias("o"), F.col("p0").alias("o0")))
    met = counts.join(others, "lang").where("s <> o")
    side = {
        ("s", "o"): _apart(F.col("p"), F.col("o0")) - _apart(F.col("s0"), F.col("o0")),
        ("o", "s"): _apart(F.col("o0"), F.col("p")) - _apart(F.col("o0"), F.col("s0")),
    }
    alone = [met.groupBy("lang", F.col(a).alias("a"), F.col(b).alias("b")).agg(F.sum(F.col("m") * x).alias("v")) for (a, b), x in side.items()]
    left, right = (groups.select("lang", *(F.col(c).alias(f"{x}_{c}") for c in ("source", "sid", "p0")), *(["kept"] if x == "a" else [])) for x in "ab")
    pairs = left.join(bounded(right), "lang").where("a_sid <> b_sid")
    none = pairs.select("lang", F.col("a_sid").alias("a"), F.col("b_sid").alias("b"), F.coalesce(F.col("kept") * _apart(F.col("a_p0"), F.col("b_p0")), F.lit(0)).alias("v"))
    total = none.unionByName(alone[0]).unionByName(alone[1]).unionByName(joint).groupBy("lang", "a", "b").agg(F.sum("v").alias("value"))
    names = groups.select("lang", "source", "sid")
    named = total.join(bounded(names.withColumnRenamed("sid", "a")), ["lang", "a"]).join(bounded(names.select("lang", F.col("source").alias("item"), F.col("sid").alias("b"))), ["lang", "b"])
    return named.select(*key, "item", "value", F.row_number().over(Window.partitionBy(*key).orderBy(F.desc("value"), "item")).alias("rank"))


def source_divergence(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank) of docs(lang, source, text).

    part `pair`: how far each other source of the language is; part `term`: the terms that set the source apart from its
    language, to rank top. A language with one source has no pairs, one without kept terms has pairs of value 0 and no terms.
    Ties go by item in UTF-8 order. All arithmetic is exact. For null values, repeated rows and empty tables see group_terms.
    """
    spark = docs.sparkSession
    group_terms(docs, least_docs).write.parquet(path := f"{shared_dir(spark)}/terms-{uuid.uuid4().hex}")
    terms = spark.read.schema("lang string, source string, term string, n long, lang_n long, head boolean").parquet(path)
    groups = cut(_groups(terms))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    pair, term = source_pairs(terms, groups).withColumn("part", F.lit("pair")), divergent_terms(terms, groups, top).withColumn("part", F.lit("term"))
    return pair.select(*columns).unionByName(term.select(*columns))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(read(spark, sf_dir, "documents"))
