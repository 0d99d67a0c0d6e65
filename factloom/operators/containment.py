"""Which quotations stand word for word in which texts, without comparing each with each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.sources.shared import checkpoint, stored

#: Words of a gram; characters of a piece of a long word; rows of grams (16 bytes each) up to which they are broadcast;
#: names of texts, and quotations without a gram (two words of a few letters), up to which they are.
GRAM, PIECE, BROADCAST_GRAMS, BROADCAST_NAMES = 3, 12, 1_000_000, 100_000


def _bound(value: Column, of: Callable[[Column], Column]) -> Column:
    """of(value), with value made once: inside a lambda it would be made anew for each element."""
    return F.get(F.transform(F.array(value), of), F.lit(0))


def _runs(words: Column, k: int) -> Column:
    """Hashes of all runs of k words; words should be a bound value."""
    n = F.size(words) - k
    run = lambda i: F.xxhash64(*(F.get(words, i + j) for j in range(k)))
    return F.when(n >= 0, F.transform(F.sequence(F.lit(0), F.greatest(n, F.lit(0))), run)).otherwise(F.array().cast("array<long>"))


def _by_size(words: Column, size: Column, other: Column) -> Column:
    for k in range(1, GRAM + 1):
        other = F.when(size == k, F.array_distinct(_runs(words, k))).otherwise(other)
    return other


def _pieces(word: Column) -> Column:
    """Hashes of all pieces of PIECE characters of a long word; a line end in front tells them from words."""
    return F.transform(F.sequence(F.lit(1), F.greatest(F.length(word) - PIECE + 1, F.lit(1))), lambda i: F.xxhash64(F.concat(F.lit("\n"), F.substr(word, i, F.lit(PIECE)))))


def quote_grams(quote: Column) -> tuple[Column, Column]:
    """(size, grams) of a quotation. Its first and last word may be parts of a text's words, those between are whole: their
    runs of GRAM words (fewer if there are fewer), sizes 1 to GRAM. Where none stands between, the first piece of its longest
    word, size 0. A quotation with neither has no grams."""
    size = F.greatest(F.least(F.size(F.split(quote, " ")) - 2, F.lit(GRAM)), F.lit(0))

    def grams(words: Column) -> Column:
        longest = F.element_at(F.array_sort(words, lambda a, b: F.length(a) - F.length(b)), -1)
        piece = F.when(F.length(longest) >= PIECE, F.array(F.xxhash64(F.concat(F.lit("\n"), F.substring(longest, 1, PIECE))))).otherwise(F.array().cast("array<long>"))
        inner = F.slice(words, 2, F.greatest(F.size(words) - 2, F.lit(0)))
        return _bound(inner, lambda x: _by_size(x, size, piece))

    return size, _bound(F.split(quote, " "), grams)


def text_grams(text: Column, sizes: list[int]) -> Column:
    """The different grams of a text of the sizes that the quotations have."""

    def grams(words: Column) -> Column:
        own = [_runs(words, k) for k in sizes if k]
        if 0 in sizes:
            own.append(F.flatten(F.transform(F.filter(words, lambda w: F.length(w) >= PIECE), _pieces)))
        return F.array_distinct(F.concat(*own)) if own else F.array().cast("array<long>")

    return _bound(F.split(text, " "), grams)


def contained(quotes: DataFrame, texts: DataFrame) -> DataFrame:
    """(key, quote), once each, of quotes(key, quote) that stand in a text of texts(key, path, text) with the same key.

    White space in texts is expected as single blanks. Each quotation is keyed by its grams; one pass over the texts hands on
    only grams that some quotation of the key has. A quotation is then looked for where its rarest gram is, and nowhere if one
    of its grams is in no text; what meets there is compared character by character. Work grows with the length of the texts and
    with the hits, and a text is moved once for those that may stand in it; up to BROADCAST_NAMES texts, no other text is
    moved. Quotations without a gram (two short words at most) are compared with all texts of their key, which are moved only
    where there are more than BROADCAST_NAMES such quotations. Null quotes, keys and texts match nothing.
    """
    size, grams = quote_grams(F.col("quote"))
    asked = checkpoint(quotes.where("key is not null and quote is not null").select("key", "quote", size.alias("size"), grams.alias("grams")).distinct())
    sizes = [r["size"] for r in asked.where(F.size("grams") > 0).select("size").distinct().collect()]  # GRAM + 1 of them at most
    each = asked.select("key", "quote", F.explode("grams").alias("gram"))
    wanted = each.select("key", "gram").distinct()
    wanted = F.broadcast(wanted) if each.count() <= BROADCAST_GRAMS else wanted
    hits = checkpoint(texts.select("key", "path", F.explode(text_grams(F.col("text"), sizes)).alias("gram")).join(wanted, ["key", "gram"], "left_semi"))
    often = hits.groupBy("key", "gram").agg(F.count("*").alias("n"))
    rarest = each.join(often, ["key", "gram"], "left").groupBy("key", "quote").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram")).alias("r")).where("r.n > 0")
    meet = stored(rarest.select("key", "quote", "r.gram").join(hits, ["key", "gram"]).select("key", "quote", "path").distinct())
    names = meet.select("key", "path").distinct()
    held = texts.join(F.broadcast(names), ["key", "path"], "left_semi") if names.count() <= BROADCAST_NAMES else texts
    found = held.join(meet, ["key", "path"]).where(F.contains("text", "quote")).select("key", "quote")
    plain = asked.where(F.size("grams") == 0).select("key", "quote")
    n = plain.count()
    if n:
        plain = F.broadcast(plain) if n <= BROADCAST_NAMES else plain
        found = found.unionByName(texts.join(plain, "key").where(F.contains("text", "quote")).select("key", "quote"))
    return found.distinct()
