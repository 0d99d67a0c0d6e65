"""Metadata layers: folder defaults and sidecars folded onto files."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.functions import text as T

#: Fields of a layer by how they fold (fixed values).
UNION_FIELDS = ("parties", "keywords", "skip_patterns", "matters", "entities", "relates_to")
OVERRIDABLE, NON_INHERITED, IRREVERSIBLE = ("date", "topic"), ("summary", "files"), ("skip",)
CATEGORIES = ("legally_obligatory", "housekeeping")
FENCE = "<!-- notes -->"


def parse_layers(raw: DataFrame) -> DataFrame:
    """layers(source, raw YAML) -> (source, key, kind, value, error), a row per key.

    kind is the YAML type (bool, str, int, float, list, map, null), so that true and "true" differ; a list
    is joined by newlines. A layer that isn't a mapping or doesn't parse is one row with an error. Each
    distinct layer is parsed once.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import yaml

        names = {bool: "bool", str: "str", int: "int", float: "float", list: "list", dict: "map", type(None): "null"}
        for b in batches:
            rows = []
            for source, text in zip(b["source"], b["raw"], strict=True):
                try:
                    data = yaml.safe_load(text or "")
                except yaml.YAMLError:
                    rows.append((source, None, None, None, "malformed"))
                    continue
                if data is None:
                    continue
                if not isinstance(data, dict):
                    rows.append((source, None, None, None, "not a mapping"))
                    continue
                for k, v in data.items():
                    kind = names.get(type(v), "str")
                    value = "\n".join(map(str, v)) if kind == "list" else None if v is None else str(v).lower() if kind == "bool" else str(v)
                    rows.append((source, str(k), kind, value, None))
            yield pd.DataFrame(rows, columns=["source", "key", "kind", "value", "error"])

    return raw.select("source", "raw").dropDuplicates(["source"]).mapInPandas(run, "source string, key string, kind string, value string, error string")


def layer_chain(files: DataFrame, layers: DataFrame) -> DataFrame:
    """Files x the layers of every ancestor folder and their own sidecar: (raw_path, source, depth, ...).

    layers(source, folder, depth, kind_of, ...): folder '' is the root; a sidecar has kind_of 'sidecar' and
    the file's path as folder. A path has as many ancestors as folders, so the explosion is small.
    """
    parts = F.split("raw_path", "/")
    folders = F.concat(F.array(F.lit("")), F.transform(F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1))), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/")))
    each = files.select("raw_path", F.explode(F.array_distinct(F.concat(folders, F.array("raw_path")))).alias("folder"))
    return each.join(layers, "folder")


def fold_scalars(values: DataFrame) -> DataFrame:
    """(raw_path, key, value): the deepest value that is not null or ''. values(raw_path, key, value, depth)."""
    return values.where("value is not null and value <> ''").groupBy("raw_path", "key").agg(F.max_by("value", "depth").alias("value"))


def fold_lists(values: DataFrame) -> DataFrame:
    """(raw_path, key, items): lists of the chain one after another, from the root, without repeats."""
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("depth", "items"))), lambda s: s["items"])
    return values.groupBy("raw_path", "key").agg(F.array_distinct(F.flatten(ordered)).alias("items"))


def locked_conflicts(values: DataFrame) -> DataFrame:
    """(raw_path, key, n): keys given several different values along the chain."""
    q = values.where("value is not null").groupBy("raw_path", "key").agg(F.countDistinct("value").alias("n"))
    return q.where("n > 1")


def resolve_legacy(values: DataFrame) -> DataFrame:
    """(raw_path, key, value, conflict) by the field's class: union, overridable, not inherited (only
    the deepest layer of the file, is_leaf), irreversible (any true), locked (one value, else a conflict)."""
    key = F.col("key")
    v = values.where("value is not null")
    leaf = v.where(~key.isin(*NON_INHERITED) | F.col("is_leaf"))
    cls = F.when(key.isin(*UNION_FIELDS), "union").when(key.isin(*OVERRIDABLE), "override").when(key.isin(*NON_INHERITED), "leaf").when(key.isin(*IRREVERSIBLE), "any").otherwise("locked")
    items = F.array_distinct(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("depth", F.split("value", "\n").alias("i")))), lambda s: s["i"])))
    g = leaf.withColumn("cls", cls).groupBy("raw_path", "key", "cls").agg(
        F.max_by("value", "depth").alias("last"), items.alias("items"), F.max(F.col("value") == "true").alias("any"), F.countDistinct("value").alias("n"), F.min_by("value", "depth").alias("first")
    )
    value = (
        F.when(F.col("cls") == "union", F.array_join("items", "\n")).when(F.col("cls") == "any", F.col("any").cast("string")).when(F.col("cls") == "locked", F.col("first")).otherwise(F.col("last"))
    )
    return g.select("raw_path", "key", value.alias("value"), ((F.col("cls") == "locked") & (F.col("n") > 1)).alias("conflict"))


def examine_layers(parsed: DataFrame, allowed: tuple[str, ...]) -> DataFrame:
    """Per layer: unknown keys, dropped (its ordinary fields don't count), and the exclusion
    signals: latched, ambiguous, reason, category flags and error texts."""
    canon = F.col("key") == "no_index"
    means = T.key_norm(F.col("key")) == "noindex"
    any_ = lambda c: F.max(F.coalesce(c, F.lit(False)))
    g = parsed.groupBy("source").agg(
        any_(F.col("error").isNotNull()).alias("unparsable"),
        any_(means & ~canon).alias("typo"),
        any_(canon).alias("named"),
        any_(canon & (F.col("kind") != "bool")).alias("not_bool"),
        any_(canon & (F.col("kind") == "bool") & (F.col("value") == "true")).alias("set"),
        F.max(F.when(F.col("key") == "no_index_reason", F.trim("value"))).alias("reason"),
        F.max(F.when(F.col("key") == "no_index_category", F.trim("value"))).alias("cat"),
        F.array_join(F.array_sort(F.collect_set(F.when(~F.col("key").isin(*allowed) & ~means, F.col("key")))), ",").alias("unknown_keys"),
        any_(F.col("key").isin("author", "claim_source")).alias("attributed"),
        any_(F.col("key") == "method").alias("has_method"),
    )
    reason = F.nullif(F.col("reason"), F.lit(""))
    cat = F.nullif(F.col("cat"), F.lit(""))
    bare = F.col("set") & reason.isNull()
    odd_cat = cat.isNotNull() & ~cat.isin(*CATEGORIES)
    errors = F.array_compact(
        F.array(
            F.when(F.col("unparsable"), "layer does not parse"),
            F.when(F.col("typo"), "suspected no_index typo"),
            F.when(F.col("not_bool"), "no_index is not a boolean"),
            F.when(bare, "no_index without reason"),
            F.when(odd_cat, "unknown category"),
            F.when(F.col("unknown_keys") != "", F.concat(F.lit("unknown keys: "), "unknown_keys")),
        )
    )
    return g.select(
        "source",
        (F.col("unparsable") | (F.col("unknown_keys") != "")).alias("dropped"),
        (F.col("unparsable") | F.col("typo") | F.col("not_bool") | F.col("set")).alias("latched"),
        (F.col("unparsable") | F.col("typo") | F.col("named")).alias("mentioned"),
        (F.col("unparsable") | F.col("typo") | F.col("not_bool") | bare).alias("ambiguous"),
        F.when(F.col("set") & ~F.col("not_bool"), reason).alias("reason"),
        F.when(~odd_cat, cat).alias("category"),
        odd_cat.alias("unknown_category"),
        F.array_join(errors, "; ").alias("errors"),
        (F.col("attributed") & ~F.col("has_method")).alias("warn_no_method"),
    )


def fold_no_index(chain: DataFrame) -> DataFrame:
    """The one-way latch over a file's chain(raw_path, depth, + examine_layers): no_index, reason, category, errors."""
    order = F.transform(F.sort_array(F.collect_list(F.struct("depth", "source", "errors"))), lambda s: s["errors"])
    g = chain.groupBy("raw_path").agg(
        F.max("latched").alias("latched"), F.max("mentioned").alias("mentioned"), F.max("ambiguous").alias("ambiguous"), F.max("unknown_category").alias("unknown"),
        F.max_by("reason", F.when(F.col("reason").isNotNull(), F.struct("depth", "source"))).alias("reason"),
        F.collect_set("category").alias("cats"), order.alias("errs"),
    )
    serious = F.col("ambiguous") | F.col("unknown") | (F.size("cats") != 1) | F.array_contains("cats", "legally_obligatory")
    return g.select(
        "raw_path",
        F.when(F.col("latched"), True).when(F.col("mentioned"), False).alias("no_index"),
        F.when(F.col("latched"), F.coalesce("reason", F.lit("fail-closed: an apparent exclusion could not be confirmed safe"))).alias("no_index_reason"),
        F.when(F.col("latched"), F.when(serious, "legally_obligatory").otherwise("housekeeping")).alias("no_index_category"),
        F.array_join(F.filter("errs", lambda e: e != ""), "; ").alias("metadata_error"),
    )


def lint(parsed: DataFrame, examined: DataFrame, layers: DataFrame, files: DataFrame) -> DataFrame:
    """K4: (source, level, finding) over all layers: errors, sidecars without a file, attribution without method."""
    errors = examined.where("errors <> ''").select("source", F.lit("error").alias("level"), F.explode(F.split("errors", "; ")).alias("finding"))
    lonely = layers.where("kind_of = 'sidecar'").join(files.select(F.col("raw_path").alias("folder")), "folder", "left_anti")
    lonely = lonely.select("source", F.lit("error").alias("level"), F.lit("orphan sidecar").alias("finding"))
    warn = examined.where("warn_no_method").select("source", F.lit("warn").alias("level"), F.lit("author or claim_source without method").alias("finding"))
    return errors.unionByName(lonely).unionByName(warn)


def strip_fence(body: Column) -> Column:
    return F.regexp_replace(body, rf"(?s)\n*{FENCE}\n.*\n{FENCE}\n?$", "")


def annotate(body: Column, notes: Column) -> Column:
    """A fenced notes block after the body, an old one replaced; unchanged where notes are blank."""
    old = strip_fence(body)
    return F.when(F.trim(F.coalesce(notes, F.lit(""))) == "", body).otherwise(F.concat(old, F.lit(f"\n\n{FENCE}\n"), F.trim(notes), F.lit(f"\n{FENCE}\n")))


def matters_of(case_number: Column, matters: Column, primary: Column) -> tuple[Column, Column]:
    """Case number and matters in order without repeats, and the primary one: the given if it is a member, else the first."""
    own = F.when(F.coalesce(case_number, F.lit("")) != "", F.array(case_number)).otherwise(F.array().cast("array<string>"))
    all_ = F.array_distinct(F.concat(own, F.coalesce(matters, F.array().cast("array<string>"))))
    return all_, F.when(F.array_contains(all_, F.coalesce(primary, F.lit(""))), primary).otherwise(F.get(all_, F.lit(0)))
