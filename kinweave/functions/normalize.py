"""Text normalisation. V folds to ASCII with column expressions; S keeps other scripts and needs Python's Unicode tables."""

from __future__ import annotations

import functools
import json
import re
import sys
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinweave.sources.schema import require

#: Abbreviations written out in names and in addresses.
NAME_WORDS = {
    "ltd": "limited", "pvt": "private", "corp": "corporation", "inc": "incorporated",
    "llp": "limited liability partnership", "llc": "limited liability company", "co": "company", "plc": "public limited company",
}
ADDRESS_WORDS = {
    "rd": "road", "st": "street", "ave": "avenue", "blvd": "boulevard", "dr": "drive", "nr": "near", "apt": "apartment", "ste": "suite",
    "hwy": "highway", "pkwy": "parkway", "ln": "lane", "ct": "court", "pl": "place", "sq": "square", "fwy": "freeway",
}
PUNCTUATION = r"[!-/:-@\[-`{-~]"
#: Python's white space, which no Java class equals.
SPACES = r"[\t-\r \x1c-\x1f\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


@functools.cache
def _folds() -> tuple[dict[str, str], dict[str, str]]:
    """Characters whose NFKD form has ASCII characters: those with one, and those with more."""
    one, many = {}, {}
    for i in range(128, sys.maxunicode + 1):
        if 0xD800 <= i < 0xE000:
            continue
        kept = "".join(c for c in unicodedata.normalize("NFKD", chr(i)) if ord(c) < 128)
        if kept:
            (one if len(kept) == 1 else many)[chr(i)] = kept
    return one, many


def _let(value: Column, body) -> Column:
    """Bind value once for body."""
    return F.transform(F.array(value), body)[0]


def _in_ascii(text: Column) -> Column:
    """text with each of its characters beyond ASCII as the ASCII characters of its NFKD form. Only the distinct ones are looked up, each replaced at once."""
    one, many = _folds()
    table = one | many
    names = "".join(table)
    values = F.array(*map(F.lit, table.values()))
    # A character's place in `names` is its place in `values`; without a place it has no ASCII form, and goes with the rest.
    place = lambda x: F.instr(F.lit(names), x)
    found = F.filter(F.array_distinct(F.regexp_extract_all(text, F.lit(r"[^\x00-\x7F]"), F.lit(0))), lambda x: place(x) > 0)
    spelled = F.aggregate(found, text, lambda out, x: F.replace(out, x, F.get(values, place(x) - 1)))
    return F.regexp_replace(spelled, r"[^\x00-\x7F]+", "")


def fold_ascii(c: Column) -> Column:
    """NFKD without what isn't ASCII; text of which nothing but white space would be left stays as it is."""
    return F.when(c.rlike(r"[^\x00-\x7F]"), _let(_in_ascii(c), lambda x: F.when(x.rlike(r"[^\t-\r \x1c-\x1f]"), x).otherwise(c))).otherwise(c)


def _written_out(text: Column, words: dict[str, str]) -> Column:
    """text with abbreviations written out; only those it holds are replaced. No full form holds an abbreviation, so their order doesn't matter."""
    found = F.array_distinct(F.regexp_extract_all(text, F.lit(rf"\b({'|'.join(words)})\b"), F.lit(1)))
    full = F.create_map(*(F.lit(x) for pair in words.items() for x in pair))
    step = lambda out, x: F.regexp_replace(out, F.concat(F.lit(r"\b"), x, F.lit(r"\b")), F.element_at(full, x))
    return F.aggregate(found, text, step)


def clean_vectorized(c: Column, words: dict[str, str]) -> Column:
    out = _let(F.lower(fold_ascii(F.coalesce(c, F.lit("")))), lambda x: _written_out(x, words))
    return F.trim(F.regexp_replace(F.regexp_replace(out, PUNCTUATION, " "), f"{SPACES}+", " "))


def clean_scalar_text(text: str | None, words: dict[str, str]) -> str:
    if not isinstance(text, str) or not text.strip():
        return ""
    out = "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c)).lower()
    for short, full in words.items():
        out = re.sub(rf"\b{short}\b", full, out, flags=re.IGNORECASE)
    return re.sub(r"\s+", " ", re.sub(PUNCTUATION, " ", out)).strip()


def clean_scalar(words: dict[str, str]):
    @F.pandas_udf(T.StringType())
    def clean(texts: pd.Series) -> pd.Series:
        return texts.map(lambda x: clean_scalar_text(x, words))

    return clean


def clean_country(c: Column) -> Column:
    return F.lower(F.regexp_replace(F.coalesce(c, F.lit("")), f"^{SPACES}+|{SPACES}+$", ""))


def normalize_entities(df: DataFrame, variant: str = "vectorized") -> DataFrame:
    """df with name_clean, address_clean and country_clean; KeyError for missing columns."""
    require(df, "business_name", "business_address", "country")
    if variant == "vectorized":
        name, address = (clean_vectorized(F.col(c), w) for c, w in (("business_name", NAME_WORDS), ("business_address", ADDRESS_WORDS)))
    elif variant == "scalar":
        name, address = clean_scalar(NAME_WORDS)("business_name"), clean_scalar(ADDRESS_WORDS)("business_address")
    else:
        raise ValueError(variant)
    return df.withColumns({"name_clean": name, "address_clean": address, "country_clean": clean_country(F.col("country"))})
