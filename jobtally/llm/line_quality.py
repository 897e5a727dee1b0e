"""Line-first quality rules, native: DataFrame functions only.

Every line is judged by punctuation, navigation, symbol and boilerplate rules;
failing lines are removed, and a document that loses more than ``MAX_LOST`` of
its word characters with them is rejected. Two document rules come before:
too few words, or too many words inside repeated 5-word windows.

Repeated windows are found inside the row: the window hashes of a text are
sorted with their positions packed into the low bits, and neighbours compared,
so the work is n log n also for a very long text, and no row is exploded.

Defined cases: a null or empty text has no words and fails the word rule;
repeated rows get the same verdict each; an empty table gives an empty result;
other columns pass through (result names begin with ``lq_``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtally.llm.common import SPACES, WORD, let

# Symbol characters, navigation marks, boilerplate phrases.
SYMBOLS = "#*$%&|<>"
NAV_MARKS = "|»›•·"
BOILERPLATE = (
    "all rights reserved", "cookie policy", "privacy policy", "terms of use", "terms of service",
    "enable javascript", "lorem ipsum", "click here", "sign up", "log in", "subscribe now", "skip to content",
)

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
MAX_LOST_PERCENT = 30
SPAN = 5
SHORT_LINE = 8
BOILERPLATE_WORDS = 30


def _count_of(text: Column, characters: str) -> Column:
    return F.char_length(text) - F.char_length(F.translate(text, characters, ""))


def _word_chars(text: Column) -> Column:
    return F.char_length(F.translate(text, SPACES, ""))


def words_of(text: Column) -> Column:
    bare = F.btrim(text, F.lit(SPACES))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, r"[\x20\x09-\x0D]+"))


def line_passes(line: Column) -> Column:
    """Whether a line survives: see the module's rules; a line without a word passes."""
    words = F.regexp_count(line, F.lit(WORD))
    marks = _count_of(line, NAV_MARKS)
    runs = F.regexp_count(line, F.lit(r"[!?]{2,}|\.{4,}"))
    navigation = (marks >= 3) & (marks * 4 >= words)
    shouting = (runs >= 3) & (runs * 4 >= words)
    symbols = (_count_of(line, SYMBOLS) >= 5) & (_count_of(line, SYMBOLS) * 10 >= _word_chars(line))
    stub = (words < SHORT_LINE) & ~line.rlike(r"[.!?:;,…]")
    boilerplate = (words < BOILERPLATE_WORDS) & line.rlike("(?i)" + "|".join(BOILERPLATE))
    return (words == 0) | ~(navigation | shouting | symbols | stub | boilerplate)


def repeated_words(words: Column, span: int = SPAN) -> Column:
    """How many words lie in a ``span``-word window that occurs twice or more."""

    def covered(starts: Column) -> Column:
        reach = F.transform(starts, lambda s, j: F.least(F.coalesce(F.get(starts, j + 1) - s, F.lit(span)), F.lit(span)))
        return F.aggregate(reach, F.lit(0).cast("long"), lambda a, x: a + x)

    def repeats(hashes: Column, low: Column) -> Column:
        high = F.bitwise_not(low)

        def among(keys: Column) -> Column:
            def same(a: Column, b: Column) -> Column:
                alike = a.bitwiseAND(high) == b.bitwiseAND(high)
                exact = F.get(hashes, a.bitwiseAND(low).cast("int")) == F.get(hashes, b.bitwiseAND(low).cast("int"))
                return F.coalesce(alike & exact, F.lit(False))

            found = F.filter(keys, lambda k, j: same(k, F.get(keys, j - 1)) | same(k, F.get(keys, j + 1)))
            return let(F.sort_array(F.transform(found, lambda k: k.bitwiseAND(low))), covered)

        packed = F.transform(hashes, lambda h, i: h.bitwiseAND(high).bitwiseOR(i.cast("long")))
        return let(F.sort_array(packed), among)

    def windows(each: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(each) - span)
        hashes = F.transform(starts, lambda i: F.xxhash64(*[F.get(each, i + d) for d in range(span)]))
        # as many low bits as the largest position needs, the others from the hash
        bits = F.char_length(F.bin(F.size(each)))
        low = F.pow(F.lit(2.0), bits).cast("long") - 1
        return let(low, lambda m: let(hashes, lambda h: repeats(h, m)))

    hashed = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) < span + 1, F.lit(0).cast("long")).otherwise(let(hashed, windows))


def judge(docs: DataFrame) -> DataFrame:
    """``docs`` with lq_words, lq_word_chars, lq_symbols, lq_dup_lines, lq_repeat_words,
    lq_base_failed, lq_lost_chars, lq_kept and lq_text (the text without failing lines)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.split(text, "\n")
    worded = F.filter(lines, lambda x: F.btrim(x, F.lit(SPACES)) != "")
    out = docs.withColumns({
        "lq_words": F.size(words_of(text)).cast("long"),
        "lq_word_chars": _word_chars(text).cast("long"),
        "lq_symbols": _count_of(text, SYMBOLS).cast("long"),
        "lq_dup_lines": let(worded, lambda a: F.size(a) - F.size(F.array_distinct(a))).cast("long"),
        "lq_repeat_words": let(words_of(text), lambda w: repeated_words(w)),
        "lq_text": F.array_join(F.filter(lines, line_passes), "\n"),
    })
    out = out.withColumns({
        "lq_base_failed": (F.col("lq_words") < MIN_WORDS)
        | (F.col("lq_repeat_words") * 100 > F.col("lq_words") * MAX_REPEAT_PERCENT),
        "lq_lost_chars": F.col("lq_word_chars") - _word_chars(F.col("lq_text")),
    })
    lost = F.col("lq_lost_chars") * 100 > F.col("lq_word_chars") * MAX_LOST_PERCENT
    return out.withColumn("lq_kept", ~F.col("lq_base_failed") & ~lost)


def cleaned(docs: DataFrame) -> DataFrame:
    """The kept documents with their surviving lines, in the columns of ``docs``."""
    names = docs.columns
    out = judge(docs).where("lq_kept").withColumn("text", F.col("lq_text"))
    if "n_chars" in names:
        out = out.withColumn("n_chars", F.char_length("text").cast("long"))
    return out.select(*[F.col(f"`{n}`") for n in names])


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM d),
p AS (SELECT r, unnest(range(1, len(words) - 3)) AS i, words FROM w WHERE len(words) >= 5),
g AS (SELECT r, i, array_to_string(words[i:i + 4], ' ') AS gram FROM p),
q AS (SELECT r, unnest(range(i, i + 5)) AS spot FROM (SELECT r, i, count(*) OVER (PARTITION BY r, gram) AS n FROM g) WHERE n >= 2),
rep AS (SELECT r, count(DISTINCT spot) AS n_repeat_words FROM q GROUP BY r),
l AS (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d),
m AS (
  SELECT r, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words,
         len(regexp_extract_all(line, '[|»›•·]')) AS marks,
         len(regexp_extract_all(line, '[!?]{2,}|\.{4,}')) AS runs,
         len(regexp_extract_all(line, '[#*$%&|<>]')) AS symbols,
         len(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g')) AS chars
  FROM l),
v AS (
  SELECT *, words > 0 AND (
         (marks >= 3 AND marks * 4 >= words) OR (runs >= 3 AND runs * 4 >= words)
         OR (symbols >= 5 AND symbols * 10 >= chars)
         OR (words < 8 AND NOT regexp_matches(line, '[.!?:;,…]'))
         OR (words < 30 AND regexp_matches(line, '(?i)all rights reserved|cookie policy|privacy policy|terms of use|terms of service|enable javascript|lorem ipsum|click here|sign up|log in|subscribe now|skip to content'))) AS fails
  FROM m),
s AS (
  SELECT r, count(*) FILTER (words > 0) - count(DISTINCT line) FILTER (words > 0) AS n_dup_lines,
         coalesce(sum(chars) FILTER (fails), 0) AS lost
  FROM v GROUP BY r),
o AS (
  SELECT d.doc_id, len(w.words)::BIGINT AS n_words,
         len(regexp_replace(d.text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         len(regexp_extract_all(d.text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         s.n_dup_lines::BIGINT AS n_dup_lines, coalesce(rep.n_repeat_words, 0)::BIGINT AS n_repeat_words, s.lost
  FROM d JOIN w USING (r) JOIN s USING (r) LEFT JOIN rep USING (r)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM o)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT lost * 100 > word_chars * 30 AS kept
FROM b
"""
