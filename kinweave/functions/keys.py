"""Blocking keys: several views of a record, each a string with a tag, in the order that the caps read them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tokens(c: Column) -> Column:
    return F.filter(F.split(c, " "), lambda t: t != "")


def soundex(token: Column) -> Column:
    """American Soundex; a first character that is no letter is kept, upper-cased, with the codes of the rest."""
    other = F.concat(F.upper(F.substring(token, 1, 1)), F.substring(F.soundex(F.concat(F.lit("a"), F.substring(token, 2, 1 << 20))), 2, 3))
    return F.when(token.rlike("^[a-z]"), F.soundex(token)).otherwise(other)


def _first_long(toks: Column) -> Column:
    return F.get(F.filter(toks, lambda t: F.length(t) >= 5), F.lit(0))


def blocking_keys(df: DataFrame, phonetic: bool = True) -> DataFrame:
    """(entity_id, src_ord, row_ord, ord, key): one row a key of each normalised record."""
    bound = df.select("entity_id", "src_ord", "row_ord", F.col("name_clean").alias("nm"), F.col("address_clean").alias("ad"), F.when(F.col("country_clean") == "", "xx").otherwise(F.col("country_clean")).alias("co"))
    bound = bound.withColumns({"toks": tokens(F.col("nm")), "atoks": tokens(F.col("ad"))})
    article = (F.size("toks") > 1) & F.get("toks", F.lit(0)).isin("the", "a", "an")
    bound = bound.withColumns({"ps": F.when(article, F.array_join(F.slice("toks", 2, F.greatest(F.size("toks"), F.lit(1))), " ")).otherwise(F.col("nm")), "tok": _first_long(F.col("toks")), "sorted": F.array_sort(F.filter("toks", lambda t: F.length(t) >= 4))})
    nm, ad, co, ps, tok = (F.col(c) for c in ("nm", "ad", "co", "ps", "tok"))
    named = F.length(nm) >= 5
    weak = ~named & (F.length(ad) >= 4)
    p5, p7, a6, a7 = F.substring(ps, 1, 5), F.substring(ps, 1, 7), F.substring(ad, 1, 6), F.substring(ad, 1, 7)
    key = lambda tag, *parts: F.concat(F.lit(f"{tag}:"), *parts)
    sep = F.lit("_")
    emitted = [
        (1, F.when(named & (F.length(p5) >= 4), key("c5", co, sep, p5))),
        (2, F.when(named & (F.length(p7) >= 5), key("c7", co, sep, p7))),
        (3, F.when(named & tok.isNotNull(), key("ct", co, sep, tok))),
        (4, F.when(named & (F.length(p7) >= 5), key("p7", p7))),
        (5, F.when(named & (F.size("sorted") >= 2), key("st", F.array_join("sorted", "_")))),
        (1, F.when(weak & (F.length(F.trim(a6)) >= 4), key("ca", co, sep, F.trim(a6)))),
        (2, F.when(weak & _first_long(F.col("atoks")).isNotNull(), key("at", co, sep, _first_long(F.col("atoks"))))),
        (3, F.when(weak & (F.length(F.trim(a7)) >= 5), key("ap", F.trim(a7)))),
        (4, F.when(~named & (F.length(ad) >= 3) & (F.length(a6) >= 4), key("aa", co, sep, a6))),
    ]
    if phonetic:
        emitted.append((6, F.when(named & (F.size("toks") > 0), key("ph", co, sep, soundex(F.coalesce(tok, F.get("toks", F.lit(0))))))))
    found = F.filter(F.array(*(F.struct(F.lit(o).alias("ord"), k.alias("key")) for o, k in emitted)), lambda s: s["key"].isNotNull())
    return bound.select("entity_id", "src_ord", "row_ord", F.explode(found).alias("s")).select("entity_id", "src_ord", "row_ord", "s.ord", "s.key")
