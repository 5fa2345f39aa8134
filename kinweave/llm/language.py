"""Language identification in two steps: the family first, then one-versus-one linear SVMs within it.

Features are relative frequencies of a text's letter bigrams, trigrams and four-letter runs, hashed.
A first one-versus-one set of linear support vector machines tells the language families apart; within
the family that wins, each pair of its languages has a machine of its own, trained on these two
languages alone, and the language with most votes wins, then with the largest sum of margins.
Families come from a table of language codes; a language that isn't in it is a family by itself.

Training: a bounded sample (SAMPLE texts of each language, by a hash of doc_id) outside the held-out
fold. Null text, or text without a letter: und, score 0. Repeated rows get the same answer. Very long
texts: whole, a block at a time. Extra columns pass through; own columns of the same names are
replaced. One learned language: always that one. No labelled text: und for all. Empty table: no rows.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kinweave.llm.common import blocks, fresh, small_batches, table
from kinweave.llm.toxicity import svm

#: Labelled texts of each language, buckets of hashed runs of letters.
SAMPLE, BUCKETS = 400, 1 << 12
#: Codes of languages by family.
FAMILIES = {
    "germanic": "en de nl af sv da no nb nn is fo fy lb yi",
    "romance": "fr es pt it ro ca gl oc la",
    "slavic": "ru uk be pl cs sk bg mk sr hr bs sl",
    "baltic": "lt lv",
    "celtic": "ga gd cy br",
    "indo-aryan": "hi bn ur mr ne gu pa si",
    "iranian": "fa ku ps tg",
    "semitic": "ar he am mt",
    "turkic": "tr az kk uz ky tk tt",
    "uralic": "fi et hu",
    "dravidian": "ta te kn ml",
    "sinitic": "zh yue",
    "austronesian": "id ms jv tl mi",
}
_FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes.split()}
_SIZES = (2, 3, 4)
_U = np.uint32


def family(lang: str) -> str:
    return _FAMILY.get(lang.lower().split("-")[0].split("_")[0], lang)


def _lower(texts: pa.Array) -> pa.Array:
    return pc.utf8_lower(texts.cast(pa.large_string()))


def _letters(block) -> np.ndarray:
    """Bytes with every one but letters (ASCII or beyond) as a space."""
    b = block.raw
    keep = ((b >= 97) & (b <= 122)) | (b >= 128)
    return np.where(keep, b, np.uint8(32)).astype(_U)


def runs(block):
    """(place, bucket) of each run of letters' bytes, size by size; runs of white space alone count too, alike in all texts."""
    x = _letters(block)
    h = np.zeros(len(x), _U)
    for size in range(1, max(_SIZES) + 1):
        n = len(x) - size + 1
        if n <= 0:
            return
        h = h[:n] * _U(0x01000193) + x[size - 1 :] + _U(size)
        if size in _SIZES:
            yield np.arange(n), ((h * _U(0x9E3779B1)) >> _U(20)).astype(np.int64), size


class Model:
    """languages; machines: weights (BUCKETS, m) with biases; the pairs of families come first."""

    def __init__(self, languages: list[str]):
        self.languages = languages
        self.families = sorted({family(x) for x in languages})
        self.pairs = [("family", a, b) for a, b in itertools.combinations(self.families, 2)]
        for f in self.families:
            own = [x for x in languages if family(x) == f]
            self.pairs += [(f, a, b) for a, b in itertools.combinations(own, 2)]
        self.weights = np.zeros((BUCKETS, len(self.pairs)), np.float32)
        self.biases = np.zeros(len(self.pairs))

    def margins(self, texts: pa.Array) -> np.ndarray:
        """(texts, machines): sums of weights over the text's runs, over the number of runs."""
        out = np.zeros((len(texts), len(self.pairs)))
        for i, j, block in blocks(_lower(texts)):
            at = block.at
            size = np.maximum(np.diff(at), 1)
            for place, bucket, width in runs(block):
                ends = np.maximum(at[1:] - width + 1, at[:-1])
                for m in range(len(self.pairs)):
                    total = np.zeros(len(place) + 1)
                    np.cumsum(self.weights[bucket, m], out=total[1:], dtype=np.float64)
                    out[i:j, m] += total[np.minimum(ends, len(place))] - total[np.minimum(at[:-1], len(place))]
            out[i:j] /= size[:, None]
        return out + self.biases

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        margins = self.margins(texts)
        names, scores = [], np.zeros(len(margins))
        for i, m in enumerate(margins):
            k, p = self._decide(m, "family", self.families)
            own = [x for x in self.languages if family(x) == self.families[k]]
            j, q = self._decide(m, self.families[k], own)
            names.append(own[j])
            scores[i] = p * q
        return names, scores

    def _decide(self, margins: np.ndarray, level: str, names: list[str]) -> tuple[int, float]:
        """(winner, its least confidence against the others) among names; ties go to the larger sum of margins, then to the first."""
        if len(names) == 1:
            return 0, 1.0
        votes, total = np.zeros(len(names)), np.zeros(len(names))
        sure = np.ones(len(names))
        at = {x: i for i, x in enumerate(names)}
        for (group, a, b), m in zip(self.pairs, margins, strict=True):
            if group != level:
                continue
            i, j = at[a], at[b]
            votes[i if m >= 0 else j] += 1
            total[i] += m
            total[j] -= m
            p = 1 / (1 + np.exp(-np.clip(3 * m, -50, 50)))
            sure[i], sure[j] = min(sure[i], p), min(sure[j], 1 - p)
        k = max(range(len(names)), key=lambda x: (votes[x], total[x], -x))
        return k, float(sure[k])


def features(texts: pa.Array) -> np.ndarray:
    """Relative frequencies of the buckets, one row a text."""
    out = np.zeros((len(texts), BUCKETS), np.float32)
    for i, j, block in blocks(_lower(texts), most=1 << 17):
        at = block.at
        row = np.repeat(np.arange(j - i), np.diff(at))
        for place, bucket, width in runs(block):
            ok = place + width <= at[1:][row[place]]
            out[i:j] += np.bincount(row[place[ok]] * BUCKETS + bucket[ok], minlength=(j - i) * BUCKETS).reshape(j - i, BUCKETS)
        out[i:j] /= np.maximum(np.diff(at), 1)[:, None]
    return out


def training_rows(docs: DataFrame, sample: int = SAMPLE) -> list[tuple[np.ndarray, str]]:
    """(features, lang), at most `sample` of each language, outside the held-out fold, of a text with a letter.

    The features are made on the executors, so the driver gets a row of BUCKETS numbers for each, however long the texts are.
    """
    small_batches(docs.sparkSession)
    ok = (F.crc32(F.col("doc_id").cast("string")) % 3 != 1) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")
    known = docs.where(ok).select("doc_id", "text", "lang")
    order = F.xxhash64("doc_id", F.lit(3))
    ids = known.select("doc_id", "lang").distinct().withColumn("o", order)
    # The least hashes of a language are below a bound by its number of documents: four times the sample stand there, so that a frequent language is no hot key.
    counts = ids.groupBy("lang").agg(F.count("*").alias("all_of_lang"))
    bound = (F.least(F.lit(1.0), 4.0 * sample / F.col("all_of_lang")) - 0.5) * 2.0**64
    near = ids.join(counts, "lang").where((F.col("all_of_lang") <= 4 * sample) | (F.col("o") < bound))
    first = W.partitionBy("lang").orderBy("o", "doc_id")
    ids = near.withColumn("rn", F.row_number().over(first)).where(F.col("rn") <= sample).select("doc_id", "lang")
    rows = known.join(F.broadcast(ids), ["doc_id", "lang"], "left_semi")  # `sample` of each language

    def run(batches):
        for batch in batches:
            x = features(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array([r.tobytes() for r in x], pa.binary())], ["doc_id", "lang", "x"])

    found = rows.select("doc_id", "text", "lang").mapInArrow(run, "doc_id long, lang string, x binary").groupBy("doc_id", "lang").agg(F.min("x").alias("x"))
    return [(np.frombuffer(x, np.float32), lang) for _, lang, x in sorted((r["doc_id"], r["lang"], bytes(r["x"])) for r in found.collect())]


def train(rows: list[tuple[np.ndarray, str]]) -> Model:
    languages = sorted({lang for _, lang in rows})
    model = Model(languages)
    if len(languages) < 2:
        return model
    x = np.stack([v for v, _ in rows])
    lang = np.array([y for _, y in rows])
    fam = np.array([family(y) for y in lang])
    scale = 1 / np.maximum(np.sqrt((x**2).mean(0)), 1e-3)  # of each bucket
    for k, (group, a, b) in enumerate(model.pairs):
        of = fam if group == "family" else lang
        mine = np.flatnonzero((of == a) | (of == b))
        y = np.where(of[mine] == a, 1.0, -1.0)
        weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum()))
        w, bias = svm((x[mine] * scale).astype(np.float64) * 0.05, y, weight, rounds=120)
        model.weights[:, k] = w * scale * 0.05
        model.biases[k] = bias
    return model


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """docs, all columns, with lang_pred and score."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    own = [f for f in docs.schema if f.name not in ("lang_pred", "score")]
    has_letter = fresh(docs, "has_letter")

    def run(batches):
        m = shared.value
        for batch in batches:
            column = lambda name: batch.column(batch.schema.get_field_index(name))  # noqa: E731, B023
            letter = column(has_letter).to_pylist()
            names, scores = (["und"] * len(letter), np.zeros(len(letter))) if not m.languages else m.predict(column("text").fill_null(""))
            names = [x if ok else "und" for x, ok in zip(names, letter, strict=True)]
            columns = {f.name: column(f.name) for f in own} | {"lang_pred": pa.array(names, pa.string()), "score": pa.array(np.where(letter, scores, 0.0) if letter else scores)}
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in own] + ["lang_pred string", "score double"])
    return docs.withColumn(has_letter, F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))).mapInArrow(run, schema)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(training_rows(docs.select("doc_id", "text", "lang")))
    held_out = (F.crc32(F.col("doc_id").cast("string")) % 3 == 1).alias("held_out")
    return identify(docs.select("doc_id", "text"), model).select("doc_id", held_out, "lang_pred", "score")
