"""Records of two tables that describe the same thing, matched without a key (problem 2).

Method. Rows become profiles of comparable attributes: the numbers they name,
the year, the chamber of the reference list, the set of subject terms. Pairs of
profiles that share a block are candidates. On each of them several labelling
functions vote (number, year, delay of publication, chamber, subject); a vote
may be for, against, in between, or an abstention. A generative label model
with two classes, match and other, learns how often each function votes what in
each class: among others from all pairs of rows, counted without being made, and the counts of
the numbers, among matches by expectation maximisation on the counts of the
candidates' vote patterns. Pairs of functions whose votes depend on each other within a class, by conditional
mutual information, get a joint distribution and the model is fitted again. The
posterior of its pattern is a pair's confidence.

Blocks. A true pair shares a number (with the year, the chamber or a term, or
with nothing left to compare), or all subject terms with the year or chamber,
or a number but for one digit or two swapped ones with year and chamber. Numbers alone
make no block, since other series reuse them. A number that very many profiles have makes
the same blocks by another way, with the same results.

Terms are spelled alike before: each distinct term becomes the nearest one that is
``DOMINATING`` times as frequent, found by an equi join on pieces of which one must
be shared; the counts needed do not depend on the size of the input.

Scale. Rows equal in all attributes are one profile, compared by value, so copies of a row, a third of all rows even,
are compared once; ids join in only for the pairs that match. Blocks are equi
joins of several attributes, so they stay small as the input grows; only hashes of the
blocks and numbers of the profiles are shuffled for them, and the attributes join in once a pair. Spark splits
a hot one by its skew handling. Pairs that share a very common number are as many as
they are, and grow with the square of its rows; they are not kept but joined twice, over classes
of equal attributes: to count their votes and to pick those that match. The model sees only pattern counts, at most a
few hundred rows whatever the input.

Nulls: a missing attribute abstains and opens no block. A pair that has nothing
but the number in common is no match. Ties have equal
confidence; every copy of a row is reported. Empty tables give no pairs.
"""

from __future__ import annotations

import itertools
import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from lexmill.llm.lookalikes import one_form
from lexmill.llm.vocabulary import CHAMBER_NOISE, ReferenceTrie, allowed_errors, chamber_entries, fold, light_fold, map_values
from lexmill.session import checkpointed

#: Occurrences of a term that others are spelled like, and by how much it is more frequent than they are.
LEAST_TERM, DOMINATING = 3, 8
#: Terms of which all sets are counted; pairs of profiles of more terms are joined on a term, with the same results.
SUBSET_TERMS = 6
#: Longer terms are compared as they are.
MOST_LETTERS = 200
#: Pairs that share a number of more profiles than this, and of this share of all, are joined over classes and not kept.
COMMON_ROWS, COMMON_SHARE = 500, 1e-3
#: A joint distribution for two functions from this conditional mutual information (nats) on.
DEPENDENT = 0.02
#: Votes of each labelling function, from the one most for a match to the one most against; "" abstains.
VOTES = {
    "number": ("same", "near", "other"),
    "year": ("same", "next", "other"),
    "delay": ("usual", "other"),
    "chamber": ("same", "other"),
    "subject": ("same", "part", "two", "one", "none"),
}
#: Years from a decision to the issue that prints it.
MOST_DELAY = 3
#: Letters read for digits and the Arabic and Persian digits, and the ASCII digits for them (fixed values).
_DIGITS = ("lIOo|" + "٠١٢٣٤٥٦٧٨٩" + "۰۱۲۳۴۵۶۷۸۹", "11001" + "0123456789" * 2)
_ATTRIBUTES = ("nums", "year", "issue", "chamber", "terms")
_COLUMNS = ("profile", *_ATTRIBUTES)
_STRINGS = ArrayType(StringType())
_SEPARATOR = re.compile(r"\s*[-–،,/:;؛]\s+|\s+[-–،,/:;؛]\s*|[،؛;]")


def numbers(column: Column) -> Column:
    """The numbers of at least five digits, Arabic and Persian ones too, that a text names, letters read for digits put right."""
    digits = F.translate(column, *_DIGITS)
    digits = F.regexp_replace(digits, r"(?<=\d)[ .](?=\d{3}(?!\d))", "")
    found = F.transform(F.regexp_extract_all(digits, F.lit(r"\d{5,18}"), F.lit(0)), lambda x: x.cast("long"))
    return F.when(column.isNull(), F.array().cast("array<long>")).otherwise(F.array_distinct(found))


def year_of(text: Column) -> Column:
    """The first year of a date in any layout, or null."""
    return F.nullif(F.regexp_extract(text, r"(?<!\d)((?:19|20)\d\d)(?!\d)", 1), F.lit("")).cast("int")


def full_year(year: Column, near: Column) -> Column:
    """A year that may be shortened to its last digits, completed to lie closest to ``near``."""
    last = year % 100
    old, new = last + 1900, last + 2000
    anchor = F.coalesce(near, F.lit(2005))
    return F.when(year >= 1000, year).when(year.isNotNull(), F.when(F.abs(anchor - old) < F.abs(anchor - new), old).otherwise(new))


def split_terms(text: str | None) -> list[str]:
    return [] if text is None else [x for x in (light_fold(t) for t in _SEPARATOR.split(one_form(text)[0])) if x]


@F.pandas_udf(_STRINGS)
def _terms(subjects: pd.Series) -> pd.Series:
    return subjects.map(split_terms)


@F.pandas_udf(StringType())
def _letters(terms: pd.Series) -> pd.Series:
    return terms.map(fold)


def pieces(length: int, errors: int) -> list[tuple[int, int]]:
    """Start and end of the pieces of a term, one of which an equal stretch holds whatever ``errors`` do to it: a swap spoils two."""
    n = 2 * errors + 1
    return [(length * i // n, length * (i + 1) // n) for i in range(n)]


@F.pandas_udf(_STRINGS)
def _held_keys(terms: pd.Series) -> pd.Series:
    """Keys of the pieces of a term, for all numbers of errors."""
    return terms.map(lambda t: [f"{e} {len(t)} {i} {t[a:b]}" for e in range(4) for i, (a, b) in enumerate(pieces(len(t), e)) if b > a])


@F.pandas_udf(_STRINGS)
def _asked_keys(terms: pd.Series) -> pd.Series:
    """Keys of the pieces of all terms that a term may be a misspelling of."""

    def keys(term: str) -> list[str]:
        e, out = allowed_errors(len(term)), set()
        for length in range(max(1, len(term) - e), len(term) + e + 1):
            for i, (a, b) in enumerate(pieces(length, e)):
                out |= {f"{e} {length} {i} {term[a + d:b + d]}" for d in range(-e, e + 1) if 0 <= a + d < b + d <= len(term)}
        return sorted(out)

    return terms.map(keys)


@F.pandas_udf(StringType())
def _nearest(terms: pd.Series, others: pd.Series) -> pd.Series:
    """The nearest of the others within the errors allowed, of equally near ones the most frequent, or null."""

    def one(term: str, near: list) -> str | None:
        trie = ReferenceTrie(((i, o["letters"]) for i, o in enumerate(near)), letters=str)
        found = trie.search(term, allowed_errors(len(term)))
        return near[min(found, key=lambda i: (found[i], -near[i]["n"], near[i]["term"]))]["term"] if found else None

    return pd.Series([one(t, list(o)) for t, o in zip(terms, others)], dtype=object)


def canonical_terms(rows: DataFrame) -> DataFrame:
    """``term, canonical`` of the terms (column ``terms``) that are spelled like a far more frequent one."""
    counts = rows.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("n"))
    counts = checkpointed(counts.withColumn("letters", _letters("term")).filter(F.length("letters") <= MOST_LETTERS))
    asked = counts.select("term", "letters", "n", F.explode(_asked_keys("letters")).alias("key"))
    frequent = counts.filter(F.col("n") >= LEAST_TERM).select(F.struct("n", "letters", "term").alias("other"), "letters")
    held = frequent.select("other", F.explode(_held_keys("letters")).alias("key"))
    near = asked.join(held, "key").filter((F.col("other.n") >= DOMINATING * F.col("n")) & (F.col("term") != F.col("other.term")))
    grouped = near.groupBy("term", "letters").agg(F.collect_set("other").alias("others"))
    return grouped.select("term", _nearest("letters", "others").alias("canonical")).filter("canonical IS NOT NULL")


def profiled(rows: DataFrame, canonical: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``side, profile`` and the attributes of rows that are alike in all of them, and ``side, id, profile`` of each row."""
    alike = rows.select("side", *_ATTRIBUTES).distinct().withColumn("profile", F.monotonically_increasing_id())
    alike = checkpointed(alike)
    spelled = alike.select("profile", F.explode("terms").alias("term")).join(canonical, "term", "left").groupBy("profile")
    spelled = spelled.agg(F.sort_array(F.collect_set(F.coalesce("canonical", "term"))).alias("spelled"))
    unique = alike.join(spelled, "profile", "left").withColumn("terms", F.coalesce("spelled", F.array().cast("array<string>")))
    named = alike.select("profile", *[F.col(c).alias(f"of_{c}") for c in ("side", *_ATTRIBUTES)])
    same = [F.col(f"of_{c}").eqNullSafe(F.col(c)) for c in ("side", *_ATTRIBUTES)]
    members = rows.join(named, same).select("side", "id", "profile")
    return unique.select("side", *_COLUMNS), members


def _attributes(rows: DataFrame, row_id: str, number: str, year: Column, issue: Column, chamber: str, subject: str, reference: DataFrame) -> DataFrame:
    near = map_values(F.col(chamber), chamber_entries(reference), CHAMBER_NOISE)
    # both functions in one step, so that rows go to Python once
    shaped = rows.select(
        F.col(row_id).alias("id"), numbers(F.col(number)).alias("nums"), year.alias("year"), issue.alias("issue"), near.alias("near"), _terms(F.col(subject)).alias("terms")
    )
    return shaped.select("id", "nums", "year", "issue", F.get("near", F.lit(0))["entry_id"].alias("chamber"), "terms")


def index_attributes(rows: DataFrame, reference: DataFrame) -> DataFrame:
    issue = F.col("issue_year")
    plausible = F.when(F.col("decision_year") > 0, F.col("decision_year"))
    return _attributes(rows, "id", "decision_number", full_year(plausible, issue), issue, "chamber", "subject", reference)


def decision_attributes(rows: DataFrame, reference: DataFrame) -> DataFrame:
    return _attributes(rows, "id", "decision_number", year_of(F.col("date")), F.lit(None).cast("int"), "chamber", "subject", reference)


def _mask() -> Column:
    """Which of year, chamber and terms a profile has."""
    has = (F.col("year").isNotNull(), F.col("chamber").isNotNull(), F.size("terms") > 0)
    return sum((F.when(h, 1 << i).otherwise(0) for i, h in enumerate(has)), F.lit(0))


def _wild(number: Column) -> Column:
    """A number with each digit left out in turn, and its digits sorted (two swapped)."""
    text = number.cast("string")
    places = F.sequence(F.lit(1), F.length(text))
    gaps = F.transform(places, lambda i: F.concat(F.substring(text, F.lit(1), i - 1), F.lit("?"), F.substring(text, i + 1, F.length(text))))
    return F.concat(gaps, F.array(F.array_join(F.array_sort(F.split(text, "")), "")))


def _list(numbers_: list[int]) -> Column:
    return F.array(*[F.lit(n) for n in numbers_]).cast("array<long>")


def _cross(tag: str, a: Column, b: Column) -> Column:
    """Hashes of all pairs of values; blocks that hash alike only make candidates."""
    return F.flatten(F.transform(a, lambda x: F.transform(b, lambda y: F.xxhash64(F.lit(tag), x, y))))


def _compared(side: str) -> dict[str, Column]:
    """What a shared number needs besides, by kind. The left side also looks into the years before and after."""
    years = F.filter(F.array(*[F.col("year") + d for d in ((-1, 0, 1) if side == "left" else (0,))]), lambda y: y.isNotNull())
    chambers = F.filter(F.array("chamber"), lambda c: c.isNotNull())
    # left profiles name every mask of the right that has nothing in common with theirs
    masks = F.filter(F.sequence(F.lit(0), F.lit(7)), lambda m: m.bitwiseAND(_mask()) == 0) if side == "left" else F.array(_mask())
    return {"y": years, "c": chambers, "t": F.col("terms"), "m": masks}


def _keys(side: str, common: list[int]) -> Column:
    """Hashed block keys of a profile, but for the pairs that share one of the numbers ``common``."""
    compared = _compared(side)
    years, chambers = compared["y"], compared["c"]
    all_terms = F.when(F.size("terms") >= 2, F.array(F.concat_ws("|", "terms"))).otherwise(F.array().cast("array<string>"))
    nums = F.array_except("nums", _list(common)) if common else F.col("nums")
    return F.array_distinct(
        F.concat(
            *[_cross(f"n{kind}", nums, values) for kind, values in compared.items()],
            _cross("ty", all_terms, years),
            _cross("tc", all_terms, chambers),
            _cross("wy", F.flatten(F.transform("nums", _wild)), _cross("", years, chambers)),
        )
    )


def _near(a: Column, b: Column) -> Column:
    """One digit apart, or two neighbours swapped."""
    x, y = a.cast("string"), b.cast("string")
    return (F.levenshtein(x, y) <= 1) | (
        (F.length(x) == F.length(y)) & (F.levenshtein(x, y) == 2) & (F.array_sort(F.split(x, "")) == F.array_sort(F.split(y, "")))
    )


def votes() -> dict[str, Column]:
    """The labelling functions over columns ``l_*`` and ``r_*``."""
    nums, nums_r = F.col("l_nums"), F.col("r_nums")
    near = F.exists(nums, lambda a: F.exists(nums_r, lambda b: _near(a, b)))
    years = F.abs(F.col("l_year") - F.col("r_year"))
    delay = F.col("l_issue") - F.col("r_year")
    common = F.size(F.array_intersect("l_terms", "r_terms"))
    left, right = F.size("l_terms"), F.size("r_terms")
    return {
        "number": F.when((F.size(nums) == 0) | (F.size(nums_r) == 0), "").when(F.arrays_overlap(nums, nums_r), "same").when(near, "near").otherwise("other"),
        "year": F.when(years.isNull(), "").when(years == 0, "same").when(years == 1, "next").otherwise("other"),
        "delay": F.when(delay.isNull(), "").when(delay.between(0, MOST_DELAY), "usual").otherwise("other"),
        "chamber": F.when(F.col("l_chamber").isNull() | F.col("r_chamber").isNull(), "").when(F.col("l_chamber") == F.col("r_chamber"), "same").otherwise("other"),
        "subject": F.when((left == 0) | (right == 0), "")
        .when((common == left) & (common == right), "same")
        .when(common == left, "part")
        .when(common >= 2, "two")
        .when(common == 1, "one")
        .otherwise("none"),
    }


def common_numbers(rows: DataFrame) -> list[int]:
    """Numbers of more than ``COMMON_ROWS`` profiles and ``COMMON_SHARE`` of all; at most ``1 / COMMON_SHARE`` of them."""
    counts = rows.select(F.explode("nums").alias("num")).groupBy("num").agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).first()[0] or 0
    return sorted(r["num"] for r in counts.filter(F.col("n") > max(COMMON_ROWS, COMMON_SHARE * total)).collect())


def _side(unique: DataFrame, name: str) -> DataFrame:
    return unique.filter(F.col("side") == name)


def _prefixed(rows: DataFrame, name: str, columns: tuple[str, ...]) -> DataFrame:
    return rows.select(*[F.col(c).alias(f"{name[0]}_{c}") for c in columns])


def _plain_pairs(unique: DataFrame, common: list[int]) -> DataFrame:
    """Pairs of profiles that share a block and none of the numbers ``common``, once each, with the votes on them."""

    def blocks(name: str) -> DataFrame:
        return _side(unique, name).select(F.explode(_keys(name, common)).alias("block"), F.col("profile").alias(f"{name[0]}_profile"))

    paired = blocks("left").join(blocks("right"), "block").select("l_profile", "r_profile").distinct()
    for name in ("left", "right"):
        paired = paired.join(_prefixed(_side(unique, name), name, _COLUMNS), f"{name[0]}_profile")
    if common:
        paired = paired.filter(~F.arrays_overlap(F.array_intersect("l_nums", _list(common)), F.col("r_nums")))
    return paired.select("l_profile", "r_profile", *[v.alias(k) for k, v in votes().items()])


def _classes(unique: DataFrame, common: list[int]) -> tuple[DataFrame, DataFrame]:
    """Profiles with numbers ``common``, of those numbers and all else alike, as classes of ``n``, and ``side, class, profile``."""
    held = unique.withColumn("nums", F.array_sort(F.array_intersect("nums", _list(common)))).filter(F.size("nums") > 0)
    grouped = held.groupBy("side", *_ATTRIBUTES).agg(F.count("*").alias("n"), F.collect_list("profile").alias("profiles"))
    classes = checkpointed(grouped.withColumn("class", F.monotonically_increasing_id()))
    return classes.drop("profiles"), classes.select("side", "class", F.explode("profiles").alias("profile"))


def _common_pairs(classes: DataFrame) -> DataFrame:
    """Pairs of classes that share a number and a block, once each, with their votes and the number ``n`` of profile pairs.

    Nothing of a pair is shuffled or kept: of the blocks that it shares only the first one gives it.
    """

    def keyed(kind: str, values: Column) -> Column:
        return F.transform(values, lambda v: F.struct(F.lit(kind).alias("kind"), v.cast("string").alias("value")))

    def side(name: str) -> DataFrame:
        columns = ("class", *_ATTRIBUTES, "n")
        blocks = [keyed(kind, values) for kind, values in _compared(name).items()]
        numbered = _side(classes, name).withColumn("num", F.explode("nums")).withColumn("key", F.explode(F.concat(*blocks)))
        return numbered.select("num", "key.kind", "key.value", *[F.col(c).alias(f"{name[0]}_{c}") for c in columns])

    kind = F.col("kind")
    years = F.coalesce(F.abs(F.col("l_year") - F.col("r_year")) <= 1, F.lit(False))
    chambers = F.coalesce(F.col("l_chamber") == F.col("r_chamber"), F.lit(False))
    first = (
        kind.isin("y", "m")
        | ((kind == "c") & ~years)
        | ((kind == "t") & ~years & ~chambers & (F.col("value") == F.array_min(F.array_intersect("l_terms", "r_terms"))))
    )
    paired = side("left").join(side("right"), ["num", "kind", "value"]).filter(first)
    paired = paired.filter(F.col("num") == F.array_min(F.array_intersect("l_nums", "r_nums")))
    return paired.select("l_class", "r_class", (F.col("l_n") * F.col("r_n")).alias("n"), *[v.alias(k) for k, v in votes().items()])


def candidates(unique: DataFrame) -> DataFrame:
    """Pairs of profiles that share a block, once each, with the votes on them."""
    common = common_numbers(unique)
    plain = _plain_pairs(unique, common)
    if not common:
        return plain
    classes, members = _classes(unique, common)
    shared = _common_pairs(classes)
    for name in ("left", "right"):
        shared = shared.join(_prefixed(_side(members, name), name, ("class", "profile")), f"{name[0]}_class")
    return plain.unionByName(shared.select(plain.columns))


class LabelModel:
    """Two-class generative model of votes; factors are functions or dependent pairs of them.

    ``patterns``: vote patterns of the candidates and their numbers ``n``; ``chance``:
    those of all pairs, or the votes of each function and each two; ``number_chance``: how often random pairs of numbers are
    the same and near; ``pairs``: how many pairs there are in all.
    """

    def __init__(self, patterns: pd.DataFrame, chance: pd.DataFrame | dict[tuple[str, ...], pd.DataFrame], number_chance: tuple[float, float], pairs: float):
        self.names = list(VOTES)
        self.patterns = patterns.reset_index(drop=True)
        self.count = self.patterns["n"].to_numpy(float)
        self.chance = chance if isinstance(chance, dict) else {names: chance for k in (1, 2) for names in itertools.combinations(self.names, k)}
        same, near = (max(x, 1e-12) for x in number_chance)
        self.number_chance = {"same": same, "near": near, "other": max(1 - same - near, 1e-12)}
        self.pairs = max(pairs, self.count.sum(), 1.0)
        self.factors: list[tuple[str, ...]] = [(n,) for n in self.names]
        self.posterior = self._start()
        self._fit()
        joined = self._dependent()
        if joined:
            self.factors = [*joined, *((n,) for n in self.names if not any(n in j for j in joined))]
            self._fit()

    def _start(self) -> np.ndarray:
        """Share of the functions that vote for a match, those that abstain left out."""
        score = np.zeros(len(self.patterns))
        for name, options in VOTES.items():
            rank = self.patterns[name].map({v: 1 - 2 * i / (len(options) - 1) for i, v in enumerate(options)})
            score += rank.fillna(0).to_numpy(float)
        return 1 / (1 + np.exp(-4 * (score - 2)))

    def _log_tables(self, factor: tuple[str, ...], votes: pd.DataFrame, weight: np.ndarray) -> np.ndarray:
        """Log probability of the factor's votes, learned from weighted votes, for each pattern.

        A function that abstains says nothing; of a pair the other's own distribution is taken then.
        """
        out = np.zeros(len(self.patterns))
        silent = {n: (self.patterns[n] == "").to_numpy() for n in factor}
        for speaking in itertools.product((True, False), repeat=len(factor)):
            names = [n for n, s in zip(factor, speaking) if s]
            rows = np.logical_and.reduce([silent[n] != s for n, s in zip(factor, speaking)])
            if not names or not rows.any():
                continue
            usable = np.logical_and.reduce([(votes[n] != "").to_numpy() for n in names])
            cells = float(np.prod([len(VOTES[n]) for n in names]))
            held = pd.Series(weight * usable).groupby(votes[names].agg("\x1f".join, axis=1)).sum()
            total = float((weight * usable).sum())
            mine = self.patterns[names].agg("\x1f".join, axis=1)
            # what was never seen is rare, not impossible
            out[rows] = np.log((mine.map(held).fillna(0).to_numpy(float) + 0.5 / cells) / (total + 0.5))[rows]
        return out

    def _log_chance(self, factor: tuple[str, ...]) -> np.ndarray:
        out = np.zeros(len(self.patterns))
        rest = tuple(n for n in factor if n != "number")
        if rest:
            held = self.chance[rest]
            out += self._log_tables(rest, held, held["n"].to_numpy(float))
        if "number" in factor:
            out += self.patterns["number"].map(self.number_chance).map(np.log, na_action="ignore").fillna(0).to_numpy(float)
        return out

    def _fit(self, rounds: int = 200) -> None:
        chance = sum(self._log_chance(f) for f in self.factors)
        for _ in range(rounds):
            before = self.posterior
            weight = self.count * before
            share = min(max(weight.sum(), 1e-3) / self.pairs, 0.5)
            match = np.log(share) + sum(self._log_tables(f, self.patterns, weight) for f in self.factors)
            other = np.log(1 - share) + chance
            self.posterior = 1 / (1 + np.exp(np.clip(other - match, -500, 500)))
            if np.abs(self.posterior - before).max() < 1e-6:
                break

    def _dependent(self) -> list[tuple[str, str]]:
        """Pairs of functions that depend on each other within a class, strongest first, each function once."""
        found = []
        for a, b in itertools.combinations(self.names, 2):
            most = 0.0
            classes = [(self.patterns, self.count * self.posterior)]
            if (a, b) in self.chance:  # else they depend by less than counts
                classes.append((self.chance[a, b], self.chance[a, b]["n"].to_numpy(float)))
            for votes, weight in classes:
                both = ((votes[a] != "") & (votes[b] != "")).to_numpy()
                table = pd.crosstab(votes[a][both], votes[b][both], weight[both], aggfunc="sum").fillna(0).to_numpy()
                total = table.sum()
                if total > 0:
                    p = table / total
                    q = p.sum(1, keepdims=True) * p.sum(0, keepdims=True)
                    some = p > 0
                    most = max(most, float((p[some] * np.log(p[some] / q[some])).sum()))
            if most >= DEPENDENT:
                found.append((most, (a, b)))
        used: set[str] = set()
        out = []
        for _, pair in sorted(found, reverse=True):
            if not used & set(pair):
                out.append(pair)
                used |= set(pair)
        return out

    def table(self) -> list[tuple]:
        """Votes and confidence, which is 0 for a pair that only shares a number: no match, since other series reuse numbers."""
        supported = (
            self.patterns["year"].isin(["same", "next"]) | (self.patterns["chamber"] == "same") | self.patterns["subject"].isin(["same", "part", "two"])
        )
        confidence = np.where(supported, self.posterior, 0.0)
        return [(*(str(r[n]) for n in self.names), float(p)) for (_, r), p in zip(self.patterns.iterrows(), confidence)]


def _subsets() -> Column:
    """All sets of a profile's terms: size, hash and whether it is all of them; of a profile of many terms the empty one alone."""
    none = F.array(F.array().cast("array<bigint>"))
    grown = F.aggregate(F.transform("terms", lambda t: F.xxhash64(t)), none, lambda sets, t: F.concat(sets, F.transform(sets, lambda s: F.concat(s, F.array(t)))))
    sets = F.when(F.size("terms") <= SUBSET_TERMS, grown).otherwise(none)
    return F.transform(sets, lambda s: F.struct(F.size(s).alias("size"), F.xxhash64(s).alias("key"), (F.size(s) == F.size("terms")).alias("whole")))


#: What a labelling function compares, on the left and on the right.
_SIDES = {"year": ("year", "year"), "delay": ("issue", "year"), "chamber": ("chamber", "chamber"), "number": ("nums", "nums")}


def _subject_chance(weighted: DataFrame, name: str, lists: DataFrame | None = None) -> pd.DataFrame:
    """Joint votes of ``name`` and the subject on all pairs of rows that both have terms.

    Pairs that share so many terms are counted from the rows that have each set of
    terms, by inclusion and exclusion; those of profiles of many terms are joined.
    """
    vote = votes()

    def side(which: str, column: str) -> DataFrame:
        rows = _side(weighted, which).filter(F.size("terms") > 0).select(F.col(column).alias("x"), "n", F.explode(_subsets()).alias("s"))
        whole = F.sum(F.when(F.col("s.whole"), F.col("n")).otherwise(0))
        p = which[0]
        return rows.groupBy(F.col("x").alias(f"{p}_{column}"), "s.size", "s.key").agg(F.sum("n").alias(f"{p}_n"), whole.alias(f"{p}_whole"))

    left, right = side("left", _SIDES[name][0]), side("right", _SIDES[name][1])
    if lists is None:
        paired = left.join(right, ["size", "key"])
    else:
        paired = left.join(lists, "l_nums").join(right, ["r_nums", "size", "key"])
    sums = [F.sum(F.col(a) * F.col(b)).alias(c) for a, b, c in (("l_n", "r_n", "all"), ("l_whole", "r_n", "within"), ("l_whole", "r_whole", "same"))]
    found = paired.select("*", vote[name].alias("x")).groupBy("x", "size").agg(*sums).toPandas()
    counts: dict[tuple[str, str], int] = {}
    for x, held in found.groupby("x"):
        of = {int(r["size"]): [int(r[c]) for c in ("all", "within", "same")] for _, r in held.iterrows()}
        sets = {j: v for j, v in of.items() if j}
        some = sum((-1) ** (j + 1) * v[0] for j, v in sets.items())
        one = sum((-1) ** (j + 1) * j * v[0] for j, v in sets.items())
        within = {j: v[1] for j, v in sets.items()}
        same = sum(v[2] for v in sets.values())
        counts[x, "same"], counts[x, "part"] = same, sum(within.values()) - same
        counts[x, "one"] = one - within.get(1, 0)
        counts[x, "two"] = some - one - sum(n for j, n in within.items() if j > 1)
        counts[x, "none"] = of.get(0, [0])[0] - some
    long = F.size("terms") > SUBSET_TERMS
    if not weighted.filter(long).isEmpty():

        def terms(rows: DataFrame, which: str) -> DataFrame:
            return _side(rows, which).select(F.explode("terms").alias("term"), F.col("profile").alias(f"{which[0]}_profile"))

        short = weighted.filter(~long)
        shared = terms(weighted.filter(long), "left").join(terms(weighted, "right"), "term").unionByName(terms(short, "left").join(terms(weighted.filter(long), "right"), "term"))
        shared = shared.select("l_profile", "r_profile").distinct()
        for which in ("left", "right"):
            shared = shared.join(_prefixed(_side(weighted, which), which, (*_COLUMNS, "n")), f"{which[0]}_profile")
        if lists is not None:
            shared = shared.join(lists, ["l_nums", "r_nums"])
        rows = shared.select(vote[name].alias("x"), vote["subject"].alias("s"), (F.col("l_n") * F.col("r_n")).alias("n")).groupBy("x", "s").agg(F.sum("n").alias("n"))
        for r in rows.collect():
            counts[r["x"], r["s"]] = counts.get((r["x"], r["s"]), 0) + r["n"]
            counts[r["x"], "none"] -= r["n"]
    return pd.DataFrame([(x, s, n) for (x, s), n in counts.items() if n], columns=[name, "subject", "n"])


def _number_lists(weighted: DataFrame) -> DataFrame:
    """``l_nums, r_nums``: the different lists of numbers that share one or have near ones, once each."""
    text = lambda n: n.cast("string")
    less = lambda n: F.transform(F.sequence(F.lit(1), F.length(text(n))), lambda i: F.concat(F.substring(text(n), F.lit(1), i - 1), F.substring(text(n), i + 1, F.length(text(n)))))

    def side(which: str) -> DataFrame:
        keys = F.flatten(F.transform("nums", lambda n: F.concat(_wild(n), F.array(text(n)), less(n))))
        return _side(weighted, which).select("nums").distinct().select(F.col("nums").alias(f"{which[0]}_nums"), F.explode(F.array_distinct(keys)).alias("key"))

    paired = side("left").join(side("right"), "key").select("l_nums", "r_nums").distinct()
    return paired.filter(votes()["number"].isin("same", "near"))


def _entropy(shares: list[float]) -> float:
    return -sum(p * float(np.log(p)) for p in shares if p > 0)


def chance_votes(unique: DataFrame, members: DataFrame, number: tuple[float, float]) -> dict[tuple[str, ...], pd.DataFrame]:
    """How all pairs of rows vote: joint counts ``n`` of the votes of each function and of each two, by their names.

    Nothing is drawn and no pair of rows is made: rows are counted by what a function
    compares, and counts are multiplied. Numbers and another function depend on each
    other by at most the entropy of the numbers' votes, of which ``number`` gives the shares;
    their joint votes are counted only where this reaches ``DEPENDENT``.
    """
    weighted = checkpointed(unique.join(members.groupBy("profile").agg(F.count("*").alias("n")), "profile"))
    vote = votes()
    plain = ["year", "delay", "chamber"]

    def grouped(which: str, columns: tuple[str, ...]) -> DataFrame:
        rows = _side(weighted, which).withColumn("has", F.size("nums") > 0).withColumn("spoken", F.size("terms") > 0)
        return _prefixed(rows.groupBy(*columns).agg(F.sum("n").alias("n")), which, (*columns, "n"))

    both = grouped("left", ("year", "issue", "chamber", "has", "spoken")).crossJoin(F.broadcast(grouped("right", ("year", "chamber", "has", "spoken"))))
    speaks = (F.col("l_has") & F.col("r_has")).alias("number"), (F.col("l_spoken") & F.col("r_spoken")).alias("subject")
    joint = both.select(*[vote[n].alias(n) for n in plain], *speaks, (F.col("l_n") * F.col("r_n")).alias("n"))
    joint = joint.groupBy(*plain, "number", "subject").agg(F.sum("n").alias("n")).toPandas()

    def silent(name: str) -> pd.DataFrame:
        """Votes where the subject, and for that matter the number, says nothing."""
        rest = joint[~joint["subject"]].groupby([name], as_index=False)["n"].sum()
        return rest.assign(subject="")

    out: dict[tuple[str, ...], pd.DataFrame] = {(n,): joint[[n, "n"]].groupby([n], as_index=False)["n"].sum() for n in plain}
    out |= {p: joint[[*p, "n"]].groupby(list(p), as_index=False)["n"].sum() for p in itertools.combinations(plain, 2)}
    for name in plain:
        out[name, "subject"] = pd.concat([_subject_chance(weighted, name), silent(name)], ignore_index=True)
    out["subject",] = out["year", "subject"].groupby(["subject"], as_index=False)["n"].sum()

    total = float(joint["n"].sum())
    named = joint[joint["number"]]
    lists = None
    for name in (*plain, "subject"):
        spoken = named[named["subject"]] if name == "subject" else named[named[name] != ""]
        pairs = float(spoken["n"].sum())
        shares = [min(x * total / pairs, 1 / 3) for x in (number[0], 2 * number[1])] if pairs else []  # near ones of another length are in no count
        if not pairs or _entropy([*shares, 1 - sum(shares)]) < DEPENDENT:
            continue
        if lists is None:
            lists = checkpointed(_number_lists(weighted))
        if name == "subject":
            found = _subject_chance(weighted, "number", lists)
            rest = pd.Series({s: n for s, n in _other_subject(weighted).items()})
        else:
            sides = [_prefixed(_side(weighted, w).groupBy("nums", c).agg(F.sum("n").alias("n")), w, ("nums", c, "n")) for w, c in zip(("left", "right"), _SIDES[name])]
            paired = sides[0].join(lists, "l_nums").join(sides[1], "r_nums")
            found = paired.select(vote["number"].alias("number"), vote[name].alias(name), (F.col("l_n") * F.col("r_n")).alias("n"))
            found = found.groupBy("number", name).agg(F.sum("n").alias("n")).toPandas()
            rest = named.groupby(name)["n"].sum()
        found, rest = found[found[name] != ""], rest.drop("", errors="ignore")
        left_over = rest.subtract(found.groupby(name)["n"].sum(), fill_value=0)
        other = pd.DataFrame({"number": "other", name: left_over.index, "n": left_over.to_numpy()})
        out["number", name] = pd.concat([found, other[other["n"] > 0]], ignore_index=True)
    return out


def _other_subject(weighted: DataFrame) -> dict[str, int]:
    """Votes of the subject on all pairs of rows that both have numbers."""
    found = _subject_chance(weighted.filter(F.size("nums") > 0), "chamber")
    return found.groupby("subject")["n"].sum().to_dict()


def number_chance(rows: DataFrame, n_rows: dict[str, int]) -> tuple[float, float]:
    """How likely two random rows name the same number, or near ones: from counts of numbers, without pairing rows."""

    def of(name: str) -> Column:
        return F.sum(F.when(F.col("side") == name, 1.0).otherwise(0.0)).alias(name)

    counts = rows.select("side", F.explode("nums").alias("num")).groupBy("num").agg(of("left"), of("right"))
    both = F.col("left") * F.col("right")
    wild = counts.select("left", "right", F.explode(F.transform(_wild(F.col("num")), lambda k: F.xxhash64(k))).alias("key"))
    near = wild.groupBy("key").agg((F.sum("left") * F.sum("right") - F.sum(both)).alias("x")).agg(F.sum("x")).first()[0]
    same = counts.agg(F.sum(both)).first()[0]
    pairs = max(1.0, float(n_rows["left"]) * n_rows["right"])
    return float(same or 0.0) / pairs, float(near or 0.0) / pairs


def link(left: DataFrame, right: DataFrame, least: float = 0.5) -> DataFrame:
    """``left_id, right_id, confidence`` of the pairs with at least that confidence, and some.

    ``left`` and ``right`` come from ``index_attributes`` and ``decision_attributes``. Repeated rows of one id give repeated pairs.
    """
    spark = left.sparkSession
    rows = checkpointed(left.withColumn("side", F.lit("left")).unionByName(right.withColumn("side", F.lit("right"))))
    unique, members = profiled(rows, canonical_terms(rows))
    unique, members = checkpointed(unique), checkpointed(members)
    common = common_numbers(unique)
    pairs = checkpointed(_plain_pairs(unique, common))
    counts = pairs.groupBy(*VOTES).agg(F.count("*").alias("n"))
    if common:
        classes, of_class = _classes(unique, common)
        shared = _common_pairs(classes)
        counts = counts.unionByName(shared.groupBy(*VOTES).agg(F.sum("n").alias("n"))).groupBy(*VOTES).agg(F.sum("n").alias("n"))
    patterns = counts.toPandas()  # at most as many as there are patterns
    scores: list[tuple] = []
    if not patterns.empty:
        n = {r["side"]: r["count"] for r in rows.groupBy("side").count().collect()}
        same_near = number_chance(rows, n)
        scores = LabelModel(patterns, chance_votes(unique, members, same_near), same_near, float(n["left"]) * n["right"]).table()
    schema = ", ".join(f"{n} string" for n in VOTES) + ", confidence double"
    table = spark.createDataFrame(scores, schema).filter((F.col("confidence") > 0) & (F.col("confidence") >= least))

    def matched(found: DataFrame, unit: str, units: DataFrame) -> DataFrame:
        out = found.join(F.broadcast(table), list(VOTES)).select(f"l_{unit}", f"r_{unit}", "confidence")
        for name in ("left", "right"):
            ids = _side(units, name).select(F.col(unit).alias(f"{name[0]}_{unit}"), F.col("id").alias(f"{name}_id"))
            out = out.join(ids, f"{name[0]}_{unit}")
        return out.select("left_id", "right_id", "confidence")

    out = matched(pairs, "profile", members)
    if common:
        out = out.unionByName(matched(shared, "class", members.join(of_class.select("profile", "class"), "profile")))
    return out
