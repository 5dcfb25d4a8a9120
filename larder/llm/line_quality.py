"""Line-first cleaning: judge every line, drop the lines that fail, then reject texts that lost too much.

Results for odd input: a null text counts as empty; a text without words has zero counts, fails the word
minimum and is rejected; lines without a word are layout, they are neither judged nor counted as copies.
Repeated rows are judged alike. Input columns beyond the id and the text are carried by `clean` untouched.
"""

from __future__ import annotations

import operator
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.llm.common import column_of, map_texts, texts

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20
# A line fails the punctuation rule when its symbols, or its exclamation and question marks, exceed this share.
MAX_SYMBOL_PERCENT = 10
MAX_SHOUT_PERCENT = 10
# A line fails the navigation rule when bars or arrows stand at more than this share of its words.
MAX_SEPARATOR_PERCENT = 20
SEPARATORS = "|»›"
# A line fails the stutter rule when more than this share of its words repeat the word before them.
MAX_STUTTER_PERCENT = 30
# A text is rejected when the dropped lines hold more than this share of its words.
MAX_LOST_PERCENT = 30
# Phrases of pages' frames, matched in lines of at most BOILERPLATE_WORDS words.
BOILERPLATE = ["all rights reserved", "cookie policy", "privacy policy", "terms of use", "terms of service",
               "enable javascript", "click here to", "subscribe to our", "share on facebook", "lorem ipsum"]
BOILERPLATE_WORDS = 30
_BOILERPLATE = re.compile("|".join(map(re.escape, BOILERPLATE)))

FIELDS = [
    T.StructField("n_words", T.LongType()), T.StructField("word_chars", T.LongType()),
    T.StructField("n_symbols", T.LongType()), T.StructField("n_dup_lines", T.LongType()),
    T.StructField("n_repeat_words", T.LongType()), T.StructField("n_failed_lines", T.LongType()),
    T.StructField("n_lost_words", T.LongType()), T.StructField("base_failed", T.BooleanType()),
    T.StructField("kept", T.BooleanType()),
]


def line_fails(line: str, tokens: list[bytes]) -> bool:
    """Whether a line with these words breaks the punctuation, navigation, stutter or boilerplate rule."""
    words = len(tokens)
    letters = len(line) - sum(map(line.count, SPACES))
    if 100 * sum(map(line.count, SYMBOLS)) > MAX_SYMBOL_PERCENT * letters:
        return True
    if 100 * (line.count("!") + line.count("?")) > MAX_SHOUT_PERCENT * letters:
        return True
    if 100 * sum(map(line.count, SEPARATORS)) > MAX_SEPARATOR_PERCENT * words:
        return True
    if 100 * sum(map(operator.eq, tokens, tokens[1:])) > MAX_STUTTER_PERCENT * words:
        return True
    return words <= BOILERPLATE_WORDS and _BOILERPLATE.search(line.lower()) is not None


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of WINDOW words which the text holds more than once."""
    windows = list(zip(*(words[i:] for i in range(WINDOW))))
    if len(set(windows)) == len(windows):
        return 0
    times = Counter(windows)
    covered, reach = 0, 0
    for at, window in enumerate(windows):
        if times[window] > 1:
            covered += at + WINDOW - max(at, reach)
            reach = at + WINDOW
    return covered


def judge(text: str) -> tuple[list, str]:
    """The values of FIELDS for one text, and the text without its failed lines."""
    words = text.encode().split()
    n_words = len(words)
    seen: set[str] = set()
    copies = failed = lost = 0
    left = []
    for line in text.split("\n"):
        here = line.encode().split()
        if here:
            copies += line in seen
            seen.add(line)
            if line_fails(line, here):
                failed += 1
                lost += len(here)
                continue
        left.append(line)
    repeated = repeated_words(words)
    base_failed = n_words < MIN_WORDS or 100 * repeated > MAX_REPEATED_PERCENT * n_words
    kept = not base_failed and 100 * lost <= MAX_LOST_PERCENT * n_words
    values = [n_words, len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)), copies, repeated,
              failed, lost, base_failed, kept]
    return values, "\n".join(left)


def measure(docs: DataFrame) -> DataFrame:
    """doc_id and FIELDS of every row."""
    schema = T.StructType([docs.select("doc_id").schema[0], *FIELDS])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [judge(text)[0] for text in texts(batch)]
        columns = [pa.array(list(c)) for c in zip(*rows)]
        return pa.RecordBatch.from_arrays([column_of(batch, "doc_id"), *columns], names=schema.names)

    return map_texts(docs.select("doc_id", "text"), run, schema)


def clean(docs: DataFrame) -> DataFrame:
    """The kept rows with their failed lines removed, in the columns they came in; n_chars follows the text."""
    schema = docs.schema
    verdict = "__kept"
    while verdict in schema.names:
        verdict += "_"

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        judged = [judge(text) for text in texts(batch)]
        arrays = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
        arrays["text"] = pa.array([text for _, text in judged], pa.string())
        if "n_chars" in arrays:
            arrays["n_chars"] = pa.array([len(text) for _, text in judged], arrays["n_chars"].type)
        arrays[verdict] = pa.array([values[-1] for values, _ in judged], pa.bool_())
        return pa.RecordBatch.from_arrays(list(arrays.values()), names=list(arrays))

    judged = map_texts(docs, run, T.StructType([*schema.fields, T.StructField(verdict, T.BooleanType())]))
    return judged.filter(F.col(verdict)).select(*schema.names)


def sql() -> str:
    """The same measures and verdict in DuckDB SQL."""
    symbols = "[#*$%&|<>]"
    phrases = "|".join(BOILERPLATE)
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS words, string_split(text, chr(10)) AS lines FROM d),
v AS (SELECT *, list_transform(range(1, len(words) - {WINDOW - 2}), lambda i: words[i:i + {WINDOW - 1}]) AS wins FROM w),
k AS (SELECT *, list_distinct(list_filter(list_zip(list_sort(wins), list_sort(wins)[2:]), lambda p: p[1] = p[2])) AS twice
      FROM v),
r AS (SELECT *, list_transform(twice, lambda p: p[1]) AS again FROM k),
u AS (SELECT *, CASE WHEN len(again) = 0 THEN 0 ELSE len(list_distinct(flatten(list_transform(
          list_filter(range(1, len(wins) + 1), lambda i: list_contains(again, wins[i])),
          lambda i: range(i, i + {WINDOW}))))) END AS n_repeat_words FROM r),
l AS (SELECT *, list_filter(lines, lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS full_lines FROM u),
f AS (SELECT *, list_filter(full_lines, lambda x:
        100 * length(regexp_replace(x, '[^#*$%&|<>]', '', 'g'))
            > {MAX_SYMBOL_PERCENT} * length(regexp_replace(x, '[\\x20\\x09-\\x0D]', '', 'g'))
        OR 100 * length(regexp_replace(x, '[^!?]', '', 'g'))
            > {MAX_SHOUT_PERCENT} * length(regexp_replace(x, '[\\x20\\x09-\\x0D]', '', 'g'))
        OR 100 * length(regexp_replace(x, '[^{SEPARATORS}]', '', 'g'))
            > {MAX_SEPARATOR_PERCENT} * len(regexp_extract_all(x, '[^\\x20\\x09-\\x0D]+'))
        OR 100 * len(list_filter(list_zip(regexp_extract_all(x, '[^\\x20\\x09-\\x0D]+'),
                                          regexp_extract_all(x, '[^\\x20\\x09-\\x0D]+')[2:]), lambda p: p[1] = p[2]))
            > {MAX_STUTTER_PERCENT} * len(regexp_extract_all(x, '[^\\x20\\x09-\\x0D]+'))
        OR (len(regexp_extract_all(x, '[^\\x20\\x09-\\x0D]+')) <= {BOILERPLATE_WORDS}
            AND regexp_matches(lower(x), '{phrases}'))) AS bad FROM l),
m AS (SELECT doc_id, len(words) AS n_words, length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g')) AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
        len(full_lines) - len(list_distinct(full_lines)) AS n_dup_lines, n_repeat_words, len(bad) AS n_failed_lines,
        coalesce(list_sum(list_transform(bad, lambda x: len(regexp_extract_all(x, '[^\\x20\\x09-\\x0D]+')))), 0)
            AS n_lost_words FROM f),
b AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED_PERCENT} * n_words AS base_failed FROM m)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
       n_failed_lines::BIGINT AS n_failed_lines, n_lost_words::BIGINT AS n_lost_words, base_failed,
       NOT base_failed AND 100 * n_lost_words <= {MAX_LOST_PERCENT} * n_words AS kept
FROM b"""
