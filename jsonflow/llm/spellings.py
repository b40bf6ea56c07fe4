"""Spelling variants: words that differ by one code point, found by permuterm rotations.

A word is marked with a terminator and rotated. With the code point at place i turned to the end, a
rotation reads ``rest $ start`` and then that code point, so all but the last is the same for every
word that has another code point there, and equal to a whole rotation of the word that has none
there. Replacements, deletions and insertions are thus one thing: rotations that share such a
prefix. All rotations of all words are dealt out by prefix and sorted, and a scan of the sorted run
emits for each member of a group how many neighbours it has there and the best of them.

A prefix fixes all of a word but one code point, so a group is never larger than the alphabet and
one, however many words there are, and nothing is emitted pair by pair. A pair meets under one
prefix only: a replacement has one place, and of a run of equal code points only the first counts as
deleted.

Nulls and edge cases: a null or empty text has no words. A row without an id takes part, but
nothing is deleted from its runs. Rows that repeat an id or a text count as often as they occur.
Of near words with equal counts the smallest in code-point order is the form. An empty table gives
no words. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jsonflow.llm.common import stored, texts_of

LETTERS = r"[A-Za-zÀ-ÿ]"
TERMINATOR = "$"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# A near word is a form if it occurs so many times as often.
TIMES = 10


def _lowered(run: Column) -> Column:
    """A-Z alone in lower case; most runs are ASCII, where that is what ``lower`` does."""
    return F.when(F.octet_length(run) == F.char_length(run), F.lower(run)).otherwise(F.translate(run, UPPER, LOWER))


def words_of(docs: DataFrame, least_length: int = 7, least_count: int = 2, drop_every: int = 31) -> DataFrame:
    """``word, n``: the distinct words of all texts and how often they occur.

    A word is a run of letters. Where the crc32 of ``<doc_id>:<run>`` is divided by ``drop_every``, one
    code point is deleted from it. Counts are reduced on the map side.
    """
    # Shorter runs cannot become words, and a greedy run is a whole one.
    runs = F.regexp_extract_all("text", F.lit(f"{LETTERS}{{{least_length},}}"), F.lit(0))
    runs = texts_of(docs).select("doc_id", F.explode(runs).alias("run")).select("doc_id", _lowered(F.col("run")).alias("run"))
    h = F.crc32(F.concat_ws(":", F.col("doc_id").cast("string"), "run").cast("binary"))
    runs = runs.select("run", F.when(F.col("doc_id").isNotNull(), h).alias("h"))
    at = (F.col("h") % F.char_length("run")).cast("int")
    run = F.col("run")
    cut = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))
    words = runs.select(F.when(F.col("h") % drop_every == 0, cut).otherwise(run).alias("word"))
    words = words.where(F.char_length("word") >= least_length)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


def rotations(words: DataFrame) -> DataFrame:
    """``prefix, last, n``: every rotation without its last code point, and every whole one (``last`` empty)."""
    size = F.char_length("word")
    turned = words.select("word", "n", size.alias("size"), F.explode(F.sequence(F.lit(0), 2 * size)).alias("j"))
    word, whole = F.col("word"), F.col("j") >= F.col("size")
    start = F.when(whole, F.col("j") - F.col("size")).otherwise(F.col("j"))
    after = F.when(whole, start + 1).otherwise(start + 2)
    prefix = F.concat(F.substring(word, after, F.col("size")), F.lit(TERMINATOR), F.substring(word, F.lit(1), start))
    last = F.when(whole, F.lit("")).otherwise(F.substring(word, start + 1, F.lit(1)))
    return turned.select(prefix.alias("prefix"), last.alias("last"), "n")


def _group(prefix: str, members: list[tuple[str, int]]) -> Iterator[tuple[str, int, int, str]]:
    """``word, n_near, near_n, near_word`` within one group, by the two best of it."""
    tail, _, head = prefix.partition(TERMINATOR)
    whole = next((n for last, n in members if not last), None)
    ranked = sorted((-n, last) for last, n in members if last)
    # The words that become the whole one by a deletion; of a run the first place alone counts.
    longer = [(n, last) for n, last in ranked if not head.endswith(last)]
    for i, (n, last) in enumerate(ranked):
        others = ranked[1 if i == 0 else 0 :][:1]
        best = [(m, head + c + tail) for m, c in others]
        near = len(ranked) - 1
        if whole is not None and not head.endswith(last):
            near += 1
            best.append((-whole, head + tail))
        if near:
            m, word = min(best)
            yield head + last + tail, near, -m, word
    if whole is not None and longer:
        m, c = longer[0]
        yield head + tail, len(longer), -m, head + c + tail


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by prefix. Only those that share theirs are looked at one by one."""
    names = ["word", "n_near", "near_n", "near_word"]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string()]

    def groups(table: pa.Table) -> pa.RecordBatch:
        prefix = table["prefix"].combine_chunks()
        same = pc.equal(prefix.slice(1), prefix.slice(0, len(prefix) - 1)).to_numpy(zero_copy_only=False)
        some = table.take(np.flatnonzero(np.r_[False, same] | np.r_[same, False]))
        out, here, members = [], None, []
        for p, last, n in zip(some["prefix"].to_pylist(), some["last"].to_pylist(), some["n"].to_pylist()):
            if p != here:
                if members:
                    out.extend(_group(here, members))
                here, members = p, []
            members.append((last, n))
        if members:
            out.extend(_group(here, members))
        cols = list(zip(*out)) if out else [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)

    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table])
        # The last group may go on in the next batch.
        prefixes = table["prefix"]
        cut = table.num_rows - 1
        while cut and prefixes[cut - 1].as_py() == prefixes[cut].as_py():
            cut -= 1
        held = table.slice(cut)
        if cut:
            yield groups(table.slice(0, cut))
    if held is not None:
        yield groups(held)


def near_words(words: DataFrame) -> DataFrame:
    """``word, n_near, near_n, near_word``: of every word that has near words their number and the best."""
    dealt = rotations(words).repartition("prefix").sortWithinPartitions("prefix", "last")
    found = dealt.mapInArrow(_scan, "word string, n_near long, near_n long, near_word string")
    best = F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near_word").alias("word")))
    found = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
    return found.select("word", "n_near", (-F.col("best.n")).alias("near_n"), F.col("best.word").alias("near_word"))


def roots(forms: DataFrame) -> DataFrame:
    """``word, root``: where following ``word, form`` ends. Each round doubles the length of the steps;
    counts grow with every step, so that there is an end."""
    root = stored(forms.select("word", F.col("form").alias("root")))
    while True:
        over = root.select(F.col("word").alias("over"), F.col("root").alias("beyond"))
        step = root.join(over, root["root"] == over["over"], "left")
        step = stored(step.select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")))
        root = step.select("word", "root")
        if step.where("moved").isEmpty():
            return root


def group_spellings(docs: DataFrame, times: int = TIMES, **words_as) -> DataFrame:
    """``word, form, root, n, n_near, form_n``: one row per word of the corpus.

    ``form`` is the near word that occurs most often, if it occurs at least ``times`` as often as the
    word; ``root`` is where following forms ends, the word itself if it has none.
    """
    words = stored(words_of(docs, **words_as))
    known = words.join(near_words(words), "word", "left")
    is_form = F.col("near_n") >= times * F.col("n")
    known = stored(
        known.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(is_form, F.col("near_word")).alias("form"),
            F.when(is_form, F.col("near_n")).alias("form_n"),
        )
    )
    rooted = roots(known.where("form IS NOT NULL"))
    out = known.join(rooted, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def sql_check(times: int = TIMES) -> str:
    """The same in DuckDB SQL; crc32 byte by byte, near words by joins on words without one code point."""
    letters = "[A-Za-z\\x{00C0}-\\x{00FF}]"
    return f"""
    WITH RECURSIVE
    steps(i, k, c) AS (
      SELECT range, 0, range FROM range(256)
      UNION ALL SELECT i, k + 1, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM steps WHERE k < 8),
    tab AS MATERIALIZED (SELECT list(c ORDER BY i) AS tab FROM steps WHERE k = 8),
    runs AS (
      SELECT doc_id, translate(unnest(regexp_extract_all(text, '{letters}{{7,}}')), '{UPPER}', '{LOWER}') AS run FROM documents),
    counted AS (SELECT doc_id, run, count(*) AS times FROM runs GROUP BY ALL),
    bytes AS MATERIALIZED (
      SELECT run, times, flatten(list_transform(string_split(CAST(doc_id AS VARCHAR) || ':' || run, ''),
             lambda c: CASE WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS BIGINT)] ELSE [195, unicode(c) - 64] END)) AS b
      FROM counted),
    crc(run, times, b, j, h) AS (
      SELECT run, times, b, 1, CAST(4294967295 AS BIGINT) FROM bytes
      UNION ALL
      SELECT run, times, b, j + 1, xor(h >> 8, tab[(xor(h, b[j]) & 255) + 1]) FROM crc, tab WHERE j <= len(b)),
    hashed AS (SELECT run, times, xor(h, 4294967295) AS h FROM crc WHERE j = len(b) + 1),
    cut AS (
      SELECT times, CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word
      FROM hashed),
    words AS MATERIALIZED (
      SELECT word, CAST(sum(times) AS BIGINT) AS n FROM cut WHERE length(word) >= 7 GROUP BY word HAVING sum(times) >= 2),
    holes AS MATERIALIZED (
      SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest
      FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
    pairs AS (
      SELECT a.word, b.word AS near, b.n FROM holes a JOIN holes b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
      UNION SELECT a.word, b.word, b.n FROM holes a JOIN words b ON a.rest = b.word
      UNION SELECT b.word, a.word, a.n FROM holes a JOIN words b ON a.rest = b.word),
    best AS (
      SELECT word, count(*) AS n_near, first(near ORDER BY n DESC, near) AS near, max(n) AS near_n FROM pairs GROUP BY word),
    formed AS MATERIALIZED (
      SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= {times} * w.n THEN near END AS form,
             CASE WHEN near_n >= {times} * w.n THEN near_n END AS form_n
      FROM words w LEFT JOIN best b ON w.word = b.word),
    walk(word, form_now) AS (
      SELECT word, word FROM formed
      UNION ALL SELECT w.word, f.form FROM walk w JOIN formed f ON w.form_now = f.word WHERE f.form IS NOT NULL),
    ends AS (SELECT w.word, w.form_now FROM walk w JOIN formed f ON w.form_now = f.word WHERE f.form IS NULL)
    SELECT f.word, form, e.form_now AS root, n, n_near, form_n FROM formed f JOIN ends e ON f.word = e.word
    """
