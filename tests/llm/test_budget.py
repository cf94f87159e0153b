import pyarrow as pa
from pyspark.sql import functions as F

from lexmill.llm.budget import FEATURES, budget_totals, features, language_code, token_budget
from lexmill.llm.tokenizers import with_token_counts


def test_features():
    row = dict(zip(FEATURES, features(pa.array(["ab, 12\n\nçd نص", None, "", "x"]))[0]))
    assert row == {"bytes": 16, "words": 4, "digits": 2, "punctuation": 1, "latin": 3, "accented": 1, "arabic": 2, "other": 0, "lines": 2, "one": 1}
    assert features(pa.array(["zz", "a b", "c"]).slice(1))[:, FEATURES.index("words")].tolist() == [2, 1]


def test_codes(spark):
    rows = spark.createDataFrame([(x,) for x in ("AR", "ara", "ar-DZ", "fra", "Fr", "", None, "de")], "l string")
    assert [r.c for r in rows.select(language_code(F.col("l")).alias("c")).collect()] == ["ar", "ar", "ar", "fr", "fr", None, None, "de"]


def test_budget_is_near_the_count(spark):
    words = ["modalités", "de", "versement", "12", "l'indemnité", "الغرفة", "المدنية", "قرار", ";"]
    rows = [
        (i, ("fr", "AR")[i % 2], "s" if i % 3 else None, "k", " ".join(words[(i * j) % (5 + i % 2 * 4)] for j in range(1, i % 97 + 2)))
        for i in range(3000)
    ] + [(9001, "fr", "s", "k", None), (9002, None, "s", None, ""), (9003, None, None, None, "solo"), (5, "AR", None, "k", "copie")]
    df = spark.createDataFrame(rows, "id long, language string, source string, kind string, text string")
    out = token_budget(df, "id", "text", "source", "language", "kind", train=300, holdout=300)
    true = with_token_counts(df, "text").agg(F.sum("n_tokens")).first()[0]
    got = budget_totals(out).collect()
    assert abs(sum(r.est_tokens for r in got) / true - 1) < 0.02 and out.count() == len(rows)
    by = {r.doc_id: r for r in out.collect()}
    assert by[9001].est_tokens == 0 and by[9002].est_tokens == 0 and by[9003].est_tokens >= 1
    assert token_budget(df.limit(0), "id", "text", "source", "language", "kind").count() == 0
