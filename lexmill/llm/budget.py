"""Token budget per source, language and kind of document (problem 6).

Method. The tokens of a text are predicted from its bytes, words, digits,
punctuation and letters per script by a regression of its language, so that
only a bounded sample is tokenized. Texts are drawn by the hash of their id:
``train`` and ``holdout`` texts of each language at most on average, whatever
the size of the corpus (documented bounds; a language with fewer texts is
tokenized whole). The counts of the training texts are combined per task to
the sums of the normal equations, so fitting sends a few dozen numbers per
task. The tokenized holdouts then give the remaining bias: a factor for each
(source, language, kind), drawn towards that of its language where the
holdout has few tokens.

Scale: one scan counts languages, one tokenizes the sample, one predicts all
texts from their UTF-8 bytes as arrays. Nothing but sums per language and per
slice is shuffled; the largest slice costs one row a task.

Nulls: a null or empty text has 0 tokens and takes no part in fitting. A null
language, source or kind is a slice of its own. Repeated rows count each.
Language codes in any spelling come to one code (``language_code``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.llm.textbatch import by_volume, row_sums, utf8_view
from lexmill.llm.tokenizers import TOKENIZER, count_tokens

TRAIN, HOLDOUT = 4000, 4000
FEATURES = ("bytes", "words", "digits", "punctuation", "latin", "accented", "arabic", "other", "lines", "one")
#: Tokens of holdout that weigh as much as the language's own factor.
PRIOR_TOKENS = 2000.0
#: Codes of languages in use (fixed values).
CODES = {"ara": "ar", "fra": "fr", "fre": "fr", "eng": "en"}


def language_code(language: Column) -> Column:
    """``AR``, ``ara`` and ``ar-DZ`` to ``ar``; blank to null."""
    first = F.lower(F.regexp_extract(language, r"^\s*([A-Za-z]+)", 1))
    known = F.create_map(*[F.lit(x) for pair in CODES.items() for x in pair])
    return F.nullif(F.coalesce(F.try_element_at(known, first), first), F.lit(""))


def _class_table() -> np.ndarray:
    """Feature number of each UTF-8 byte; continuation bytes have none (-1)."""
    out = np.full(256, FEATURES.index("other"), np.int8)
    for b in range(128):
        c = chr(b)
        out[b] = FEATURES.index("latin") if c.isalpha() else FEATURES.index("digits") if c.isdigit() else -1 if c.isspace() else FEATURES.index("punctuation")
    out[0x80:0xC0] = -1
    out[0xC3:0xCA] = FEATURES.index("accented")
    out[0xD8:0xDC] = FEATURES.index("arabic")
    return out


_CLASS = _class_table()
_BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def features(column: pa.Array) -> np.ndarray:
    """One row of FEATURES for each text."""
    data, offsets = utf8_view(column)
    kind = _CLASS[data]
    blank = _BLANK[data]
    starts = ~blank
    starts[1:] &= blank[:-1]
    heads = offsets[:-1][offsets[:-1] < offsets[1:]]
    starts[heads] = ~blank[heads]
    out = np.empty((len(column), len(FEATURES)))
    for i, name in enumerate(FEATURES):
        if name == "bytes":
            out[:, i] = np.diff(offsets)
        elif name == "words":
            out[:, i] = row_sums(starts, offsets)
        elif name == "lines":
            out[:, i] = row_sums(data == 10, offsets)
        elif name == "one":
            out[:, i] = np.diff(offsets) > 0
        else:
            out[:, i] = row_sums(kind == i, offsets)
    return out


def _tokenized(sample: DataFrame, tokenizer: str) -> DataFrame:
    names = ", ".join(f"{f} double" for f in FEATURES)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_volume(batches, "text"):
            text = batch.column(batch.schema.get_field_index("text"))
            x = features(text)
            rest = [batch.column(batch.schema.get_field_index(c)) for c in ("source", "code", "kind", "holdout")]
            tokens = count_tokens(text.to_pylist(), tokenizer).astype(float)
            yield pa.RecordBatch.from_arrays(
                [*rest, pa.array(tokens), *(pa.array(x[:, i]) for i in range(len(FEATURES)))],
                ["source", "code", "kind", "holdout", "tokens", *FEATURES],
            )

    return sample.mapInArrow(measure, f"source string, code string, kind string, holdout boolean, tokens double, {names}")


#: Languages, by number of texts, with a regression of their own; texts of others are estimated with the mean of these.
MOST_LANGUAGES = 200


def fit(sample: DataFrame) -> dict[str | None, np.ndarray]:
    """Coefficients per language from the tokenized training texts (ridge, tiny)."""
    terms = [(a, b) for i, a in enumerate(FEATURES) for b in FEATURES[i:]]
    sums = sample.groupBy("code").agg(
        *[F.sum(F.col(a) * F.col(b)).alias(f"xx_{a}_{b}") for a, b in terms],
        *[F.sum(F.col(a) * F.col("tokens")).alias(f"xy_{a}") for a in FEATURES],
    )
    models = {}
    for row in sums.collect():  # at most MOST_LANGUAGES
        gram = np.zeros((len(FEATURES), len(FEATURES)))
        for a, b in terms:
            i, j = FEATURES.index(a), FEATURES.index(b)
            gram[i, j] = gram[j, i] = row[f"xx_{a}_{b}"]
        size = np.sqrt(np.maximum(np.diag(gram), 1.0))
        scaled = gram / size[:, None] / size[None, :] + 1e-6 * np.eye(len(size))
        moment = np.array([row[f"xy_{a}"] for a in FEATURES]) / size
        models[row["code"]] = np.linalg.solve(scaled, moment) / size
    return models


def _predict(models: dict, x: np.ndarray, codes: list) -> np.ndarray:
    fallback = models.get("*", np.zeros(x.shape[1]))
    weights = np.array([models.get(c, fallback) for c in codes]).reshape(x.shape)
    return np.where(x[:, 0] > 0, np.maximum((x * weights).sum(1), 1.0), 0.0)


def _factors(holdout: DataFrame, models: dict) -> dict[tuple, float]:
    """Tokens over prediction in the holdout, per slice, drawn towards the language's factor."""
    score = F.greatest(F.lit(1.0), sum((F.col(f) * _model_map(models, i) for i, f in enumerate(FEATURES)), F.lit(0.0)))
    rows = holdout.groupBy("source", "code", "kind").agg(F.sum("tokens").alias("t"), F.sum(score).alias("p")).collect()
    by_code: dict = {}
    for r in rows:
        t, p = by_code.get(r["code"], (0.0, 0.0))
        by_code[r["code"]] = (t + r["t"], p + r["p"])
    own = {c: t / p if p else 1.0 for c, (t, p) in by_code.items()}
    out = {(None, c, None, "code"): f for c, f in own.items()}
    for r in rows:
        out[r["source"], r["code"], r["kind"], "slice"] = (r["t"] + PRIOR_TOKENS * own[r["code"]]) / (r["p"] + PRIOR_TOKENS)
    return out


def _model_map(models: dict, i: int) -> Column:
    out = F.lit(float(models.get("*", np.zeros(len(FEATURES)))[i]))
    for code, weights in models.items():
        if code != "*":
            out = F.when(F.col("code").eqNullSafe(F.lit(code)), F.lit(float(weights[i]))).otherwise(out)
    return out


def token_budget(
    rows: DataFrame,
    doc_id: str,
    text: str,
    source: str,
    language: str,
    kind: str,
    tokenizer: str = TOKENIZER,
    train: int = TRAIN,
    holdout: int = HOLDOUT,
) -> DataFrame:
    """``doc_id, source, language, kind, n_bytes, est_tokens`` of every row."""
    base = rows.select(
        F.col(doc_id).alias("doc_id"),
        F.col(source).alias("source"),
        language_code(F.col(language)).alias("code"),
        F.col(kind).alias("kind"),
        F.col(text).alias("text"),
    )
    filled = base.filter(F.length("text") > 0)
    counts = filled.groupBy("code").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "code").limit(MOST_LANGUAGES).collect()
    lot = F.pmod(F.xxhash64(F.lit("budget"), F.col("doc_id").cast("string")), F.lit(1 << 30)) / float(1 << 30)
    share = F.lit(0.0)
    for r in counts:
        share = F.when(F.col("code").eqNullSafe(F.lit(r["code"])), F.lit((train + holdout) / r["n"])).otherwise(share)
    part = F.pmod(F.xxhash64(F.lit("holdout"), F.col("doc_id").cast("string")), F.lit(train + holdout)) >= train
    sample = _tokenized(filled.filter(lot < share).withColumn("holdout", part).drop("doc_id"), tokenizer).persist()
    try:
        models = fit(sample.filter(~F.col("holdout")))
        if models:
            models["*"] = np.mean([m for m in models.values()], axis=0)
        factors = _factors(sample.filter("holdout"), models)
    finally:
        sample.unpersist()

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_volume(batches, "text"):
            column = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            codes, sources, kinds = (column[c].to_pylist() for c in ("code", "source", "kind"))
            x = features(column["text"])
            factor = np.array(
                [factors.get((s, c, k, "slice"), factors.get((None, c, None, "code"), 1.0)) for s, c, k in zip(sources, codes, kinds)]
            )
            tokens = np.rint(_predict(models, x, codes) * factor).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [column["doc_id"], column["source"], column["code"], column["kind"], pa.array(x[:, 0].astype(np.int64)), pa.array(tokens)],
                ["doc_id", "source", "language", "document_type", "n_bytes", "est_tokens"],
            )

    kind_of_id = dict(base.dtypes)["doc_id"]
    return base.mapInArrow(
        predict, f"doc_id {kind_of_id}, source string, language string, document_type string, n_bytes long, est_tokens long"
    )


def budget_totals(tokens: DataFrame) -> DataFrame:
    """Texts, bytes and tokens of each source, language and kind."""
    return tokens.groupBy("source", "language", "document_type").agg(
        F.count_if(F.col("n_bytes") > 0).alias("n_texts"), F.sum("n_bytes").alias("n_bytes"), F.sum("est_tokens").alias("est_tokens")
    )
