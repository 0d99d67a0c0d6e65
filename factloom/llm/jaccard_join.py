"""Exact n-gram Jaccard join: T-occurrence search by DivideSkip over sharded inverted lists.

1. Documents of equal shingle sets become one class, stood for by its smallest doc_id.
2. Two filters leave what can have a link. In any common order, two sets of similarity 3/4 or more share
   more than 1/16 of a set among the first third of each, so a document stays if so many of these
   shingles stand in another document. Among those that stay, 3/4 of a set must stand elsewhere.
3. Routing. With the rarest shingles first, linked sets share one of the first n - ceil(3n/4) + 1 of
   each. Documents that meet there are chained to the smallest one; the chains' components part no link.
   Text put together from common passages makes chains of documents that are not alike, so a component of
   more than one block is routed by its leading shingles themselves: each of them names one place, and a
   document goes to the places of its own. That parts no link either, and copies don't grow with the component.
4. Each component or place (cut into blocks when large) gets inverted lists in one task, where documents are
   searched: short lists are counted, long ones probed by binary search.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import bounded, by_bytes, cut, give_back, mix, ngram_hashes, read, word_hashes
from .components import components

WORDS = 5
#: Documents and shingles in a block of one task, about, and smallest documents of a place that every block
#: is searched for.
BLOCK, BLOCK_SHINGLES, HUBS = 4_000, 2_000_000, 8
#: Of every SHARE-th document (fewer, so that there are TELLING at most), shingles in TOLD or more are taken for
#: so frequent that their rows are dealt over SALTS groups. There are few such shingles, whatever the corpus.
SHARE, TELLING, TOLD, SALTS = 64, 200_000, 32, 64
#: Rows that such a group should have at most; where a frequent shingle has more, it is dealt over more groups.
SALT_ROWS = 1_000_000
#: Shingles that a task's blocks hold together, about.
TASK_SHINGLES = 4_000_000


def sets_of(texts: pa.Array, words: int = WORDS) -> list[np.ndarray]:
    """Each text's distinct shingles as sorted 64-bit hashes; a shorter text is one shingle, an empty one none."""
    h, edge = word_hashes(texts, lower=True)
    runs, out = ngram_hashes(h, words), []
    for a, z in zip(edge.tolist(), edge[1:].tolist(), strict=False):
        out.append(np.unique(runs[a : z - words + 1]) if z - a >= words else ngram_hashes(h[a:z], z - a)[: z - a])
    return out


def first_third(s: np.ndarray) -> np.ndarray:
    """The first floor(n/3) + 1 shingles of a set in the order of a mixed hash."""
    return s[np.argsort(mix(s), kind="stable")[: len(s) // 3 + 1]]


class Lists:
    """Inverted lists of the sets of one task; a shingle of one document only has none."""

    def __init__(self, sets: list[np.ndarray]):
        self.size = np.array([len(s) for s in sets], np.int64)
        doc = np.repeat(np.arange(len(sets)), self.size)
        _, inverse, length = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        several = length > 1
        keep = several[inverse]
        doc, own = doc[keep], (np.cumsum(several) - 1)[inverse[keep]]
        order = np.argsort(own, kind="stable")  # by list, then by document
        self.doc = doc[order]
        self.length = length[several]
        self.start = np.concatenate(([0], np.cumsum(self.length)))
        self.key = own[order] * len(sets) + self.doc
        self.of = np.split(own, np.cumsum(np.bincount(doc, minlength=len(sets)))[:-1])

    def _counts(self, ids: np.ndarray) -> np.ndarray:
        """By document, how many of the lists ids it is in."""
        length = self.length[ids]
        if len(ids) and length.mean() > 64:
            docs = np.concatenate([self.doc[a:z] for a, z in zip(self.start[ids].tolist(), self.start[ids + 1].tolist(), strict=True)])
        else:
            docs = self.doc[np.arange(length.sum()) + np.repeat(self.start[ids] - (np.cumsum(length) - length), length)]
        return np.bincount(docs, minlength=len(self.size))

    def search(self, q: int, skip: np.ndarray | None = None) -> list[int]:
        """All y with 7 * overlap >= 3 * (n_q + n_y); documents marked in skip need no answer."""
        ids, n = self.of[q], int(self.size[q])
        least = -(-3 * n // 4)
        if len(ids) < least:
            return []
        # DivideSkip: the longest lists are set apart; T - L occurrences must then fall in the others.
        length = self.length[ids]
        apart = min(least - 1, int(least / (0.0085 * math.log2(length.max()) + 1)))
        order = np.argsort(length, kind="stable")
        short, far = ids[order[: len(ids) - apart]], ids[order[len(ids) - apart :]]
        count, total = self._counts(short), n + self.size
        may = (count >= least - apart) & (7 * np.minimum(n, self.size) >= 3 * total)
        may[q] = False
        if skip is not None:
            may &= ~skip
        ask = np.flatnonzero(may & (7 * count < 3 * total))
        if len(far) and len(ask):
            # Few documents are looked up in the long lists; for many it costs less to count these too.
            if len(ask) * len(far) * math.log2(len(self.key)) < self.length[far].sum():
                want = far * len(self.size) + ask[:, None]
                at = np.minimum(np.searchsorted(self.key, want), len(self.key) - 1)
                count[ask] += (self.key[at] == want).sum(axis=1)
            else:
                count += self._counts(far)
        return np.flatnonzero(may & (7 * count >= 3 * total)).tolist()


def link_group(ids: np.ndarray, sets: list[np.ndarray], known: np.ndarray, ask: np.ndarray) -> list[tuple[int, int]]:
    """Links that join what the group's links join; known: component so far, ask: whose links are wanted.

    Where all may ask, a document is searched only while it stands alone; then those outside of the
    largest component are. A link between two components has an end there, so none is lost.
    """
    n = len(ids)
    _, part = np.unique(known, return_inverse=True)
    lists, links = Lists(sets), []

    def search(q: int) -> None:
        for y in lists.search(q, part == part[q] if n > 64 else None):
            if part[q] != part[y]:
                part[part == part[y]] = part[q]
                links.append((int(ids[q]), int(ids[y])))

    done = np.zeros(n, bool)
    if ask.all():
        for q in range(n):
            if (part == part[q]).sum() == 1:
                search(q)
                done[q] = True
    if len(np.unique(part)) > 1:
        largest = np.bincount(part).argmax() if ask.all() else -1
        for q in np.flatnonzero(ask & ~done & (part != largest)):
            search(int(q))
    return links


def _links_of(rows: DataFrame, shards: int) -> DataFrame:
    """rows(task, doc_id, known, ask, sets) -> links (a, b); tasks are dealt over shards."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int]] = []
        # Most tasks have a few documents: what pandas does is done for all of them at once.
        each = pdf[["task", "doc_id", "known", "ask"]].assign(at=np.arange(len(pdf)), task=pd.factorize(pdf["task"])[0])
        each = each.groupby(["task", "doc_id"], sort=True).agg({"known": "min", "ask": "max", "at": "min"}).reset_index()
        ids, known, ask, at = (each[c].to_numpy() for c in ("doc_id", "known", "ask", "at"))
        shingles, edge = pdf["shingles"].to_numpy(), np.flatnonzero(np.diff(each["task"].to_numpy(), prepend=-1, append=-1))
        for a, z in zip(edge.tolist(), edge[1:].tolist(), strict=False):
            if z - a > 1:
                sets = [np.frombuffer(shingles[i], np.uint64) for i in at[a:z]]
                out += link_group(ids[a:z], sets, known[a:z], ask[a:z].astype(bool))
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return rows.groupBy(F.pmod(F.xxhash64("task"), F.lit(shards)).alias("shard")).applyInPandas(run, "a long, b long")


def jaccard_components(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row per row of docs.

    Null and empty texts have no shingles and are alone; a null doc_id links with nothing and has a
    null component_id. Rows that repeat a doc_id share its component; if their texts differ, the least of
    those sets that may have a link stands for the id, the others only link with equal sets. A very long
    text is one set, and alone in its block. Other columns are left out.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in by_bytes(batches, 1):
            own = sets_of(b.column(1))
            h = [xxhash.xxh3_128_digest(s.tobytes()) for s in own]
            cols = [len(s) for s in own], *([int.from_bytes(x[i : i + 8], "big", signed=True) for x in h] for i in (0, 8))
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, pa.int64()) for c in cols)], ["doc_id", "n", "h1", "h2"])
        give_back()

    def emit(choose: Callable[[np.ndarray], np.ndarray]) -> Callable:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in by_bytes(batches, 1):
                parts = [choose(s) if len(s) else s for s in sets_of(b.column(1))]
                keys = np.repeat(b.column(0).to_numpy(zero_copy_only=False), [len(p) for p in parts])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(parts).view(np.int64)), pa.array(keys)], ["token", "doc_id"])
            give_back()

        return run

    info = cut(docs.mapInArrow(survey, "doc_id long, n long, h1 long, h2 long"))
    classes = info.where("n > 0 and doc_id is not null").groupBy("h1", "h2").agg(F.min("doc_id").alias("rep"))
    members = info.join(classes, ["h1", "h2"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("rep")).alias("rep")
    )
    members = cut(members)
    firsts = members.where("rep = doc_id").groupBy("doc_id").agg(F.max("n_shingles").alias("n"))
    keyed = docs.where("doc_id is not null")

    def texts_of(ids: DataFrame) -> DataFrame:
        return keyed.join(bounded(ids.select("doc_id")), "doc_id", "left_semi")

    def counted(rows: DataFrame, choose: Callable[[np.ndarray], np.ndarray], share: int) -> DataFrame:
        """(token, doc_id, df) of rows for the tokens that stand in several of its documents.

        Tokens are counted in a window, but for those so frequent that one task could not hold their rows: they
        show in every share-th document. They are dealt over salts, and their df is what those documents tell; as
        it only sets one order for all documents, and is above 1, nothing depends on its exactness.
        """
        tell = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(share)) == 0).mapInArrow(emit(choose), "token long, doc_id long")
        tell = cut(tell.groupBy("token").agg(F.count("*").alias("told")).where(F.col("told") >= TOLD))
        each = rows.mapInArrow(emit(choose), "token long, doc_id long")
        if tell.isEmpty():
            return each.withColumn("df", F.count("*").over(Window.partitionBy("token"))).where("df > 1")
        salts = F.greatest(F.lit(SALTS), F.ceil(F.col("told") * share / SALT_ROWS))
        each = each.join(bounded(tell), "token", "left").withColumn("salt", F.when(F.col("told").isNotNull(), F.pmod(F.xxhash64("doc_id"), salts)).otherwise(0))
        there = F.count("*").over(Window.partitionBy("token", "salt"))
        return each.withColumn("df", F.coalesce(F.col("told") * share, there)).where("df > 1").select("token", "doc_id", "df")

    # Equal sets are one document from here on, so that copies make no token frequent.
    copies = members.where("rep <> doc_id").select("doc_id").distinct().join(firsts.select("doc_id"), "doc_id", "left_anti")
    single = keyed.join(bounded(cut(copies)), "doc_id", "left_anti")
    share = max(SHARE, math.ceil(firsts.count() / TELLING))
    third = counted(single, first_third, share)
    may = third.groupBy("doc_id").agg(F.count("*").alias("met")).join(firsts, "doc_id").where("met > floor(n / 16)").select("doc_id", "n")
    may = cut(may)
    common = counted(texts_of(may), lambda s: s, share)
    # A document's list is no longer than the document.
    order = F.sort_array(F.collect_list(F.struct("df", "token"))).alias("own")
    lead = (
        common.groupBy("doc_id").agg(order)
        .join(may, "doc_id")
        .where("size(own) >= ceil(3 * n / 4)")
        .withColumn("k", F.expr("cast(size(own) - ceil(3 * n / 4) + 1 as int)"))
        .select("doc_id", F.expr("own[k - 1].token").alias("home"), F.explode(F.slice("own", F.lit(1), F.col("k"))).alias("x"))
        .select("doc_id", "home", "x.token")
    )
    lead = cut(lead)
    hubs = lead.groupBy("token").agg(F.min("doc_id").alias("hub"), F.max("doc_id").alias("last")).where("hub < last").select("token", "hub")
    chains = lead.join(hubs, "token").where("doc_id <> hub").select(F.col("hub").alias("a"), F.col("doc_id").alias("b")).distinct()
    routed = components(chains)  # (node, component)
    routed = routed.join(may, F.col("node") == F.col("doc_id")).select("doc_id", "component", "n")
    place = cut(_blocks(routed))
    large = place.where("blocks > 1")
    if not large.isEmpty():
        visits = _places(lead.join(large.select("doc_id"), "doc_id", "left_semi"))
        place = place.where("blocks = 1").unionByName(cut(_blocks(visits.join(may, "doc_id"))))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in by_bytes(batches, 4):
            at = 4
            bins = [x.tobytes() for x in sets_of(b.column(at))]
            names = [*b.schema.names[:at], *b.schema.names[at + 1 :], "shingles"]
            yield pa.RecordBatch.from_arrays([*b.columns[:at], *b.columns[at + 1 :], pa.array(bins, pa.binary())], names)
        give_back()

    with_sets = (
        keyed.join(bounded(place), "doc_id")
        .select("doc_id", "component", "blocks", "block", "text")
        .mapInArrow(sets, "doc_id long, component long, blocks int, block int, shingles binary")
    )
    with_sets = cut(with_sets.groupBy("doc_id", "component", "blocks", "block").agg(F.min("shingles").alias("shingles")))
    total = with_sets.agg(F.sum(F.length("shingles") / 8).alias("n"), F.max("blocks").alias("b")).first()
    shards = max(1, math.ceil((total["n"] or 0) / TASK_SHINGLES), docs.sparkSession.sparkContext.defaultParallelism * 4)
    one = with_sets.where("blocks = 1").select(
        F.col("component").cast("string").alias("task"), "doc_id", F.col("doc_id").alias("known"), F.lit(True).alias("ask"), "shingles"
    )
    links = _links_of(one, shards)
    if (total["b"] or 0) > 1:
        links = cut(links).unionByName(_large(with_sets.where("blocks > 1"), shards))
    found = components(links)
    return members.join(found, F.col("rep") == F.col("node"), "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "rep", "doc_id").alias("component_id")
    )


def _blocks(routed: DataFrame) -> DataFrame:
    """routed(doc_id, component, n) -> (doc_id, component, blocks, block)."""
    blocks = F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int")
    size = routed.groupBy("component").agg(blocks.alias("blocks"))
    block = F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int")
    return routed.join(size, "component").select("doc_id", "component", "blocks", block.alias("block"))


def _usual(lead: DataFrame, name: str) -> DataFrame:
    """(token, name, n): the value of column name that most of a token's n rows have, ties by value."""
    each = lead.groupBy("token", name).agg(F.count("*").alias("n"))
    return each.groupBy("token").agg(F.max_by(name, F.struct("n", name)).alias(name), F.sum("n").alias("n"))


def _places(lead: DataFrame) -> DataFrame:
    """lead(doc_id, home, token) -> (doc_id, component): the places that a document goes to, none twice.

    Two documents that share a leading token meet at its place. Which one that is, is free, and so chosen that a
    document has few: a home (most frequent leading token of a document) has the usual home of its documents, and
    a token has what that is for most of its own, so that the tokens of one passage, or of a group of near copies, mostly
    name one place. Places of one document are left out.
    """
    homes = _usual(lead, "home").select(F.col("token").alias("home"), F.col("home").alias("component"))
    at = _usual(lead.join(homes, "home"), "component").where("n > 1").select("token", "component")
    visits = cut(lead.select("doc_id", "token").join(at, "token").select("doc_id", "component").distinct())
    met = visits.groupBy("component").agg(F.count("*").alias("n")).where("n > 1")
    return visits.join(met.select("component"), "component", "left_semi").select("doc_id", "component")


def _large(rows: DataFrame, shards: int) -> DataFrame:
    """Links of components or places of several blocks: every block with the place's first documents, then
    every block with those documents, a block at a time, that are not yet in the largest part."""
    hubs = (
        rows.withColumn("nth", F.row_number().over(Window.partitionBy("component").orderBy("doc_id")))
        .where(F.col("nth") <= HUBS)
        .select("component", "blocks", "doc_id", "shingles")
    )
    spread = hubs.withColumn("block", F.explode(F.expr("sequence(0, blocks - 1)"))).select("component", "block", "doc_id", "shingles")

    def task(*parts: str) -> F.Column:
        return F.concat_ws("/", *(F.col(p).cast("string") for p in parts)).alias("task")

    first = rows.select("component", "block", "doc_id", "shingles").unionByName(spread)
    first = first.select(task("component", "block"), "doc_id", F.col("doc_id").alias("known"), F.lit(True).alias("ask"), "shingles")
    links = cut(_links_of(first, shards))
    part = components(links).select(F.col("node").alias("doc_id"), F.col("component").alias("known"))
    state = rows.join(part, "doc_id", "left").withColumn("known", F.coalesce("known", "doc_id"))
    counts = state.groupBy("component", "known").agg(F.count("*").alias("n"))
    main = counts.groupBy("component").agg(F.max_by("known", F.struct("n", "known")).alias("main"))
    state = cut(state.join(main, "component"))
    rest = state.where("known <> main")
    counts = rest.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("asks"))
    ask = (
        rest.join(counts, "component")
        .withColumn("group", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.col("asks")).cast("int"))
        .withColumn("block", F.explode(F.expr("sequence(0, blocks - 1)")))
        .select(task("component", "group", "block"), "doc_id", "known", F.lit(True).alias("ask"), "shingles")
    )
    answer = (
        state.join(counts, "component")
        .withColumn("group", F.explode(F.expr("sequence(0, asks - 1)")))
        .select(task("component", "group", "block"), "doc_id", "known", F.lit(False).alias("ask"), "shingles")
    )
    return links.unionByName(_links_of(ask.unionByName(answer), shards * 4))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(read(spark, sf_dir, "documents"))
