"""Quality rules as weak supervision, in built-in functions only.

Each rule votes good, votes bad or abstains on a document. Expectation-maximisation over the
counts of vote patterns estimates how often each rule casts each vote on good and on bad
documents, and the posterior probability of being good replaces "all rules must pass".

Rules of this kind depend on each other: nearly every document is called good by most of them, and several
such votes together would outweigh the one rule that tells. Good votes are therefore heard only where no rule
votes bad; they count in what is estimated about a rule all the same.

The patterns of all documents are counted by a partial aggregation (at most 3^rules rows, however
large the corpus); each EM step is one aggregation over those counts.

Nulls and edge cases: a null text counts as empty; an empty text has no words, so it fails the
base checks. Rows are judged one by one, so repeated rows and repeated ids get equal verdicts. An
empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jsonflow.llm.common import BLANKS, stored, texts_of

GOOD, ABSTAIN, BAD = 2, 1, 0
STEPS = 20
# What is believed before any vote is seen: the share of good documents, each class's chance of a
# bad and of a good vote, and the weight of that belief as a share of all documents. Being a
# share, it acts alike at every size.
PRIOR_GOOD = 0.8
PRIOR_VOTES = {"good": (0.002, 0.998), "bad": (0.3, 0.7)}
PRIOR_SHARE = 0.01

# name, bad when, good when; between them a rule abstains. Integer arithmetic keeps engines alike.
RULES = [
    ("symbols", "10 * n_symbols > n_words", "50 * n_symbols <= n_words"),
    ("repetition", "100 * n_repeat_words > 30 * n_words", "100 * n_repeat_words <= 10 * n_words"),
    ("lines", "n_lines >= 3 AND 100 * n_dup_lines > 30 * n_lines", "n_lines >= 3 AND 100 * n_dup_lines <= 5 * n_lines"),
    ("capitals", "100 * n_upper > 30 * word_chars", "100 * n_upper <= 10 * word_chars"),
    ("word_length", "word_chars > 14 * n_words OR word_chars < 3 * n_words", "2 * word_chars BETWEEN 7 * n_words AND 20 * n_words"),
]
BASE_FAILED = "n_words < 50 OR 100 * n_repeat_words > 50 * n_words"


def _repeat_words(words: Column) -> tuple[Column, Column, Column]:
    """Steps to the words in 3-word windows found twice: sorted windows, their places, words covered."""
    last = F.size(words) - 2
    windows = F.arrays_zip(
        F.slice(words, 1, F.greatest(last, F.lit(0))).alias("a"),
        F.slice(words, 2, F.greatest(last, F.lit(0))).alias("b"),
        F.slice(words, 3, F.greatest(last, F.lit(0))).alias("c"),
    )
    hashed = F.sort_array(
        F.transform(windows, lambda x, i: F.struct(F.xxhash64(x["a"], x["b"], x["c"]).alias("h"), i.alias("i")))
    )
    s = F.col("_windows")
    beside = F.arrays_zip(s.alias("s"), F.slice(s, 2, F.greatest(F.size(s) - 1, F.lit(0))).alias("n"))
    # A pair of equal neighbours marks both places; runs repeat places, which the distinct removes.
    equal = F.filter(beside, lambda x: x["s"]["h"] == x["n"]["h"])
    places = F.sort_array(F.array_distinct(F.flatten(F.transform(equal, lambda x: F.array(x["s"]["i"], x["n"]["i"])))))
    p = F.col("_places")
    gaps = F.zip_with(
        F.slice(p, 2, F.greatest(F.size(p) - 1, F.lit(0))),
        F.slice(p, 1, F.greatest(F.size(p) - 1, F.lit(0))),
        lambda b, a: F.least(b - a, F.lit(3)),
    )
    covered = F.when(F.size(p) == 0, F.lit(0)).otherwise(F.aggregate(gaps, F.lit(3), lambda t, g: t + g))
    return hashed, places, covered


def text_counts(docs: DataFrame) -> DataFrame:
    """Counts of every whole text that the rules look at, one row per document."""
    text = F.coalesce("text", F.lit(""))
    words, lines = F.col("_words"), F.col("_lines")
    hashed, places, covered = _repeat_words(words)
    staged = texts_of(docs).select(
        "doc_id",
        text.alias("_text"),
        F.filter(F.split(text, BLANKS), lambda w: w != "").alias("_words"),
        F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("_lines"),
    )
    staged = staged.select(
        "doc_id",
        F.size(words).cast("long").alias("n_words"),
        F.char_length(F.array_join(words, "")).cast("long").alias("word_chars"),
        (F.size(F.split("_text", r"[#*$%&|<>]")) - 1).cast("long").alias("n_symbols"),
        F.size(lines).cast("long").alias("n_lines"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        (F.size(F.split("_text", "[A-ZÀ-ÖØ-Þ]")) - 1).cast("long").alias("n_upper"),
        hashed.alias("_windows"),
    )
    kept = [c for c in staged.columns if not c.startswith("_")]
    staged = staged.select(*kept, places.alias("_places"))
    return staged.select(*kept, covered.cast("long").alias("n_repeat_words"))


def votes_of(counts: DataFrame, rules=RULES) -> DataFrame:
    """Adds ``votes``: the votes of all rules as digits, the first rule's first."""
    digit = [F.when(F.expr(bad), F.lit("0")).when(F.expr(good), F.lit("2")).otherwise(F.lit("1")) for _, bad, good in rules]
    return counts.withColumn("votes", F.concat(*digit))


def _score(rules, model: dict) -> Column:
    """Log odds of good against bad. An abstention says nothing, nor does a good vote beside a bad one. The model enters as one array, so
    that the plans of all steps share their generated code."""
    flat = [math.log(model["p"]) - math.log1p(-model["p"])]
    for j in range(len(rules)):
        for v in (0, 1):
            flat.append(math.log(model["good"][j][v]) - math.log(model["bad"][j][v]))
    odds = F.array(*[F.lit(x) for x in flat])
    votes = F.split("votes", "")
    cast = F.transform(
        votes,
        lambda digit, j: F.when(digit == "0", F.get(odds, 1 + 2 * j)).when((digit == "2") & ~F.contains("votes", F.lit("0")), F.get(odds, 2 + 2 * j)).otherwise(0.0),
    )
    return F.aggregate(cast, F.get(odds, F.lit(0)), lambda t, x: t + x)


def posterior(rules, model: dict) -> Column:
    return 1 / (1 + F.exp(-_score(rules, model)))


def learn_rules(patterns: DataFrame, rules=RULES, steps: int = STEPS) -> dict:
    """``p`` and, for ``good`` and ``bad`` documents, each rule's chances of a bad and a good vote.

    ``patterns`` holds ``votes, n``. Each step brings two sums for every rule and vote to the driver.
    """
    model = {"p": PRIOR_GOOD, **{c: [PRIOR_VOTES[c]] * len(rules) for c in PRIOR_VOTES}}
    for _ in range(steps):
        weighed = patterns.select("votes", "n", posterior(rules, model).alias("g"))
        # Place -1 stands for the document itself.
        each = weighed.select("n", "g", F.posexplode(F.concat(F.array(F.lit("")), F.split("votes", ""))).alias("j", "vote"))
        sums = each.groupBy("j", "vote").agg(F.sum(F.col("n") * F.col("g")).alias("good"), F.sum(F.col("n") * (1 - F.col("g"))).alias("bad"))
        got = {(r["j"] - 1, r["vote"]): r for r in sums.collect()}
        if not got:
            return model
        total = got[-1, ""]["good"] + got[-1, ""]["bad"]
        weight = PRIOR_SHARE * total
        model = {"p": (got[-1, ""]["good"] + weight * PRIOR_GOOD) / (total + weight)}
        for c in PRIOR_VOTES:
            model[c] = []
            for j in range(len(rules)):
                cast = [got[j, v][c] if (j, v) in got else 0.0 for v in "02"]
                whole = sum(cast) + weight
                model[c].append(tuple((cast[v] + weight * PRIOR_VOTES[c][v]) / whole for v in (0, 1)))
    return model


def accuracies(model: dict, rules=RULES) -> dict[str, float]:
    """How often a rule that votes is right."""
    p = model["p"]
    return {name: p * model["good"][j][1] + (1 - p) * model["bad"][j][0] for j, (name, _, _) in enumerate(rules)}


def judge(docs: DataFrame, rules=RULES, threshold: float = 0.5) -> DataFrame:
    """Counts, ``votes``, ``p_quality``, ``base_failed`` and ``kept`` for every document."""
    voted = stored(votes_of(text_counts(docs), rules))
    model = learn_rules(stored(voted.groupBy("votes").agg(F.count("*").alias("n"))), rules)
    judged = voted.withColumn("p_quality", posterior(rules, model)).withColumn("base_failed", F.expr(BASE_FAILED))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("p_quality") >= threshold))


def sql_check(rules=RULES, steps: int = STEPS, threshold: float = 0.5) -> str:
    """The same in DuckDB SQL: the EM steps are one CTE each."""
    digits = " || ".join(f"CASE WHEN {bad} THEN '0' WHEN {good} THEN '2' ELSE '1' END" for _, bad, good in rules)
    odds = " + ".join(
        ["ln(m.p / (1 - m.p))"]
        + [
            f"CASE WHEN substr(votes, {j + 1}, 1) = '0' THEN ln(m.g{j}0 / m.b{j}0)"
            f" WHEN substr(votes, {j + 1}, 1) = '2' AND NOT contains(votes, '0') THEN ln(m.g{j}2 / m.b{j}2) ELSE 0 END"
            for j in range(len(rules))
        ]
    )
    votes = [(j, i, v) for j in range(len(rules)) for i, v in enumerate("02")]
    first = [f"CAST({PRIOR_GOOD} AS DOUBLE) AS p"]
    first += [f"CAST({PRIOR_VOTES[c][i]} AS DOUBLE) AS {c[0]}{j}{v}" for c in PRIOR_VOTES for j, i, v in votes]
    step = [f"(sum(n * g) + {PRIOR_SHARE} * sum(n) * {PRIOR_GOOD}) / (sum(n) * (1 + {PRIOR_SHARE})) AS p"]
    for c, w in (("good", "g"), ("bad", "(1 - g)")):
        step += [
            f"(sum(CASE WHEN substr(votes, {j + 1}, 1) = '{v}' THEN n * {w} ELSE 0 END) + {PRIOR_SHARE} * sum(n) * {PRIOR_VOTES[c][i]})"
            f" / (sum(CASE WHEN substr(votes, {j + 1}, 1) <> '1' THEN n * {w} ELSE 0 END) + {PRIOR_SHARE} * sum(n)) AS {c[0]}{j}{v}"
            for j, i, v in votes
        ]
    ctes = [f"m0 AS MATERIALIZED (SELECT {', '.join(first)})"]
    for k in range(steps):
        ctes.append(
            f"m{k + 1} AS MATERIALIZED (SELECT {', '.join(step)} FROM "
            f"(SELECT votes, n, 1 / (1 + exp(-({odds}))) AS g FROM patterns, m{k} m))"
        )
    blank = r"[\x20\x09-\x0D]+"
    return f"""
    WITH staged AS (
      SELECT doc_id, coalesce(text, '') AS t,
             list_filter(string_split_regex(coalesce(text, ''), '{blank}'), lambda w: w <> '') AS words,
             list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS lines
      FROM documents),
    windows AS (
      SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w) AS times FROM (
        SELECT doc_id, i, [words[i], words[i + 1], words[i + 2]] AS w FROM (
          SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM staged))),
    repeated AS (
      SELECT doc_id, count(DISTINCT i + k) AS n FROM windows, (VALUES (0), (1), (2)) v(k) WHERE times > 1 GROUP BY doc_id),
    counts AS (
      SELECT s.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
             CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
             CAST(length(t) - length(regexp_replace(t, '[A-ZÀ-ÖØ-Þ]', '', 'g')) AS BIGINT) AS n_upper,
             CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words
      FROM staged s LEFT JOIN repeated r ON s.doc_id = r.doc_id),
    voted AS MATERIALIZED (SELECT *, {digits} AS votes FROM counts),
    patterns AS MATERIALIZED (SELECT votes, CAST(count(*) AS DOUBLE) AS n FROM voted GROUP BY votes),
    {', '.join(ctes)}
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT base_failed AND p >= {threshold} AS kept, votes, round(p, 4) AS p_quality
    FROM (SELECT v.*, ({BASE_FAILED}) AS base_failed, 1 / (1 + exp(-({odds}))) AS p FROM voted v, m{steps} m)
    """
