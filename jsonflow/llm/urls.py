"""URL filters: rules first, then naive Bayes over segmented host and path words.

* **Rules** name a host suffix and a path prefix; of those that fit, the longest decides.
* **Segmentation.** A host name like ``casinowin`` is split into the words that explain it best: a
  Viterbi search over word probabilities. Those are counts of all words of the pages themselves. Only
  stretches of host names are looked up, by joins, so the vocabulary is never cut nor sent about.
* **Naive Bayes.** URLs that a rule decides teach a multinomial model which words go with each
  verdict; a few words known to name junk are added as pseudo-counts. It judges the URLs that no
  rule covers.

URLs are first counted by shape (host, and path with its numbers made equal), and words are joined
for each distinct shape, so hot hosts cost no more than rare ones; the join back is split by the
adaptive skew join. A URL that is null or without ``://`` has an empty host and path, fits no rule and is judged
by the prior alone. Repeated rows and ids are judged one by one. Odds of nought, a tie, allow. An empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jsonflow.llm.common import stored

# verdict, host, path
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
# Fixed values, and a parameter of ``judge``: words that name junk sites, and what each weighs as a share of all words.
JUNK_WORDS = ("ads", "adult", "bet", "bets", "casino", "cheap", "farm", "free", "pills", "porn", "spam", "track", "win", "xxx")
JUNK_SHARE = 0.01
SMOOTHING = 1.0
# Words of up to so many characters are looked up whole, longer ones by how they begin.
PREFIX = 8


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_name(host: str, path: str) -> str:
    return host + path


def decide(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict; null if none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    # Later conditions are asked first, so rules go from the shortest to the longest.
    for what, h, p in sorted(rules, key=lambda r: (len(rule_name(r[1], r[2])), r)):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        name = F.when(fits, F.lit(rule_name(h, p))).otherwise(name)
        verdict = F.when(fits, F.lit(what)).otherwise(verdict)
    return name, verdict


def word_counts(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``word, n`` of all words of the pages' texts, tags left out."""
    text = F.regexp_replace(F.col(html_col), r"(?s)<script.*?</script>|<style.*?</style>|<[^>]*>|&\w+;", " ")
    words = F.split(F.lower(text), r"[^\p{L}\p{N}]+")
    counted = pages.select(F.explode(words).alias("word")).where("word <> ''")
    return counted.groupBy("word").agg(F.count("*").alias("n"))


def best_split(name: str, counts: dict[str, int], total: float) -> list[str]:
    """The likeliest words of a name; letters that no word explains stay together as one.

    Of equally likely splits the one with the later last word wins. Unknown letters in a row cost the same each, so
    only the best place for such a run to begin is carried along: time grows with the name and with the number of
    different lengths its words have.
    """
    sizes = sorted({len(w) for w in counts})
    # An unknown word is ten times less likely with each letter.
    letter, unknown = math.log(10.0), math.log(total)
    best: list[tuple[float, int]] = [(0.0, 0)]
    run, run_at = 0.0, 0
    for end in range(1, len(name) + 1):
        fresh = best[end - 1][0] + (end - 1) * letter
        if fresh > run + 1e-9:
            run, run_at = fresh, end - 1
        options = [(run - end * letter - unknown, run_at)]
        for size in sizes:
            if size > end:
                break
            n = counts.get(name[end - size : end], 0)
            if n:
                options.append((best[end - size][0] + math.log(n / total), end - size))
        best.append(max(options))
    words, end = [], len(name)
    while end:
        start = best[end][1]
        words.append(name[start:end])
        end = start
    return words[::-1]


def _split(batches: Iterator[pa.RecordBatch], total: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for name, known in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            out.append(best_split(name, {k["part"]: k["n"] for k in known or () if k["n"]}, total))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(pa.string()))], ["name", "words"])


def _key(name: str) -> bytes:
    return hashlib.md5(name.encode()).digest()


def _in_parts(rows: Iterator[tuple], names: list[str], kinds: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
    while part := list(itertools.islice(rows, 10_000)):
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*part), kinds)], names)


def _short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``key, part``: a name's distinct stretches of up to ``PREFIX`` characters."""

    def rows() -> Iterator[tuple]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                key = _key(name)
                for size in range(1, PREFIX + 1):
                    yield from ((key, part) for part in {name[i : i + size] for i in range(len(name) - size + 1)})

    return _in_parts(rows(), ["key", "part"], [pa.binary(), pa.string()])


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``key, at, room, part``: where a longer word may begin, the characters left, and the first of them."""

    def rows() -> Iterator[tuple]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                key = _key(name)
                yield from ((key, i, len(name) - i, name[i : i + PREFIX]) for i in range(len(name) - PREFIX))

    return _in_parts(rows(), ["key", "at", "room", "part"], [pa.binary(), pa.int32(), pa.int32(), pa.string()])


def _long(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``key, part`` of the places and lengths asked for."""

    def rows() -> Iterator[tuple]:
        for batch in batches:
            for key, name, stretches in zip(*(batch.column(i).to_pylist() for i in range(3))):
                yield from ((key, part) for part in {name[s["at"] : s["at"] + s["n_chars"]] for s in stretches})

    return _in_parts(rows(), ["key", "part"], [pa.binary(), pa.string()])


def segment(names: DataFrame, counts: DataFrame) -> DataFrame:
    """``name, words`` for distinct names, split by the counts of ``word, n``.

    Each place of a name asks for the words of up to ``PREFIX`` characters there, and whether longer words
    begin like that; if so, for the lengths that such words have. What is asked for carries a digest of the
    name and not the name, so a name of any length gives a few short rows a character.
    """
    total = float(counts.agg(F.sum("n")).first()[0] or 1)
    names = names.select("name")
    named = names.select(F.unhex(F.md5("name")).alias("key"), "name")
    short = names.mapInArrow(_short, "key binary, part string")
    begins = counts.where(F.char_length("word") > PREFIX)
    begins = begins.select(F.substring("word", 1, PREFIX).alias("part"), F.char_length("word").alias("n_chars")).distinct()
    places = names.mapInArrow(_places, "key binary, at int, room int, part string")
    fitting = places.join(begins, "part").where("n_chars <= room")
    stretches = fitting.groupBy("key").agg(F.collect_set(F.struct("at", "n_chars")).alias("stretches"))
    long = named.join(stretches, "key").select("key", "name", "stretches").mapInArrow(_long, "key binary, part string")

    known = short.union(long).join(counts.withColumnRenamed("word", "part"), "part")
    gathered = known.groupBy("key").agg(F.collect_list(F.struct("part", "n")).alias("known"))
    whole = named.join(gathered, "key", "left").select("name", "known")
    return whole.mapInArrow(lambda b: _split(b, total), "name string, words array<string>")


def _odds(shapes: DataFrame, junk_words=JUNK_WORDS) -> tuple[DataFrame, float, float]:
    """``word, odds`` (log odds of block), of the prior, and of a word never seen."""
    judged = shapes.where("rule_verdict IS NOT NULL")
    is_block = F.col("rule_verdict") == "block"
    urls = judged.agg(F.sum(F.when(is_block, F.col("n"))).alias("block"), F.sum(F.when(~is_block, F.col("n"))).alias("allow")).first()
    counted = judged.select(F.explode("words").alias("word"), "n", is_block.alias("b")).groupBy("word")
    counted = counted.agg(F.sum(F.when(F.col("b"), F.col("n")).otherwise(0)).alias("block"), F.sum(F.when(~F.col("b"), F.col("n")).otherwise(0)).alias("allow"))
    counted = stored(counted)
    size = counted.agg(F.sum("block").alias("block"), F.sum("allow").alias("allow"), F.count("*").alias("words")).first()
    block, allow = float(size["block"] or 0), float(size["allow"] or 0)
    pseudo = max(1.0, JUNK_SHARE * (block + allow))
    junk = counted.sparkSession.createDataFrame([(w,) for w in junk_words], "junk string")
    both = counted.join(junk, counted["word"] == junk["junk"], "full")
    kinds = float(size["words"]) + len(junk_words)
    block_mass = block + pseudo * len(junk_words) + SMOOTHING * kinds
    allow_mass = allow + SMOOTHING * kinds
    extra = F.when(F.col("junk").isNotNull(), F.lit(pseudo)).otherwise(0.0)
    odds = F.log((F.coalesce("block", F.lit(0)) + extra + SMOOTHING) / block_mass) - F.log((F.coalesce("allow", F.lit(0)) + SMOOTHING) / allow_mass)
    prior = math.log(((urls["block"] or 0) + 1.0) / ((urls["allow"] or 0) + 1.0))
    return both.select(F.coalesce("word", "junk").alias("word"), odds.alias("odds")), prior, math.log(allow_mass / block_mass)


def judge(
    pages: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", junk_words=JUNK_WORDS
) -> DataFrame:
    """``page_id, host, path, rule, verdict, odds`` of every page; odds are null where a rule decides."""
    urls = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"))
    urls = urls.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    name, verdict = decide(F.col("host"), F.col("path"), rules)
    urls = urls.withColumn("rule", name).withColumn("rule_verdict", verdict)
    # All URLs of a shape hold the same words.
    urls = urls.withColumn("pattern", F.regexp_replace(F.lower("path"), "[0-9]+", "0"))
    shapes = stored(urls.groupBy("host", "pattern", "rule_verdict").agg(F.count("*").alias("n")))

    def parts(column: str) -> Column:
        return F.filter(F.split(column, r"[^\p{L}\p{N}]+"), lambda x: x != "")

    hosts = shapes.select("host").distinct()
    names = hosts.select(F.explode(parts("host")).alias("name")).distinct()
    split = segment(names, stored(word_counts(pages, html_col)))
    each = hosts.select("host", F.explode(parts("host")).alias("name")).join(split, "name")
    host_words = each.groupBy("host").agg(F.flatten(F.collect_list("words")).alias("host_words"))
    shapes = shapes.join(host_words, "host", "left")
    shapes = shapes.withColumn("words", F.concat(F.coalesce("host_words", F.array().cast("array<string>")), parts("pattern")))
    shapes = stored(shapes.select("host", "pattern", "rule_verdict", "n", "words"))

    odds, prior, unseen = _odds(shapes, junk_words)
    open_shapes = shapes.where("rule_verdict IS NULL").select("host", "pattern", F.explode_outer("words").alias("word"))
    scored = open_shapes.join(odds, "word", "left").groupBy("host", "pattern")
    # A shape without words is judged by the prior.
    scored = scored.agg((F.sum(F.when(F.col("word").isNull(), 0.0).otherwise(F.coalesce("odds", F.lit(unseen)))) + prior).alias("odds"))
    decided = urls.where("rule_verdict IS NOT NULL").select("page_id", "host", "path", "rule", F.col("rule_verdict").alias("verdict"), F.lit(None).cast("double").alias("odds"))
    by_model = urls.where("rule_verdict IS NULL").join(scored, ["host", "pattern"])
    by_model = by_model.select("page_id", "host", "path", "rule", F.when(F.col("odds") > 0, "block").otherwise("allow").alias("verdict"), "odds")
    return decided.union(by_model)
