"""URL filtering by rules, and by a character language-model ratio where no rule fits. DataFrame functions alone.

The rules decide what they fit: the longest rule wins, and a rule fits its host and all subdomains if the path
starts with the rule's. URLs that a rule allows or blocks train two character models of variable order: counts
of all windows up to ORDER + 1 characters, interpolated from the longest context seen down to a uniform one
(Witten-Bell). A URL's score is the mean over its characters of the log-probability under accepted URLs less
that under rejected ones. Of the labelled URLs a third is left out of training and sets the threshold of least balanced error. URLs with a score at or above it are allowed.

Scores are summed in millionths, as integers, so that they do not depend on the order of addition. Windows are
counted per distinct URL shape (digits folded to 0) before anything is shuffled; a table of windows is bounded
by the alphabet, and is broadcast only where its counted rows are at most BROADCAST_WINDOWS.

Results for odd input: null, or no `://`: host, path and shape are empty, no rule fits, and the empty shape is
scored like any other; repeated rows are judged alike; without labelled URLs of both kinds in the left-out
fold the threshold is 0 (it is the middle of the best edges otherwise); an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from larder.sources.tables import staged

# Rules of the registered query: verdict, host, path.
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"),
         ("allow", "org", "/fr/")]
ORDER = 4
# URLs whose MD5 in hex is below this are the fold that sets the threshold: a third.
FOLD_END = "5555"
# Characters that a shape tells apart; all others are one.
ALPHABET = string.ascii_lowercase + "0./?=&_%#:-"
UNIFORM = 1 / (len(ALPHABET) + 3)
UNIT = 1_000_000
BROADCAST_WINDOWS = 100_000
# Width of the bins in which the threshold is searched, in UNITs.
BIN = 10_000


def _lower(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def host_and_path(url: Column) -> tuple[Column, Column, Column]:
    """Host, path, and all that follows the first `://`."""
    rest = F.when(url.contains("://"), F.regexp_replace(url, r"(?s)^.*?://", "")).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    return _lower(host), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), rest


def rule_for(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule, written host then path, and its verdict; nulls if none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name, verdict = F.when(fits, rule_host + rule_path).otherwise(name), F.when(fits, says).otherwise(verdict)
    return name, verdict


def shape(rest: Column) -> Column:
    """What the models see of a URL."""
    return F.regexp_replace(F.regexp_replace(_lower(rest), "[0-9]", "0"), r"(?s)[^a-z0./?=&_%#:-]", "~")


def _windows(text: Column) -> Column:
    """Each character after its ORDER predecessors; `^` stands before the text and `$` after it."""
    padded = F.concat(F.lit("^" * ORDER), text, F.lit("$"))
    return F.transform(F.sequence(F.lit(1), F.length(padded) - ORDER), lambda i: padded.substr(i, F.lit(ORDER + 1)))


def _suffixes(windows: DataFrame) -> DataFrame:
    """One row per window and order: `gram` is the last order + 1 characters, `context` is that without its last."""
    orders = windows.withColumn("order", F.explode(F.sequence(F.lit(0), F.lit(ORDER))))
    gram = F.col("window").substr(F.lit(ORDER + 1) - F.col("order"), F.col("order") + 1)
    return orders.withColumn("gram", gram).withColumn("context", F.col("gram").substr(F.lit(1), F.col("order")))


def window_scores(counts: DataFrame, wanted: DataFrame) -> DataFrame:
    """(window, score): log-ratio of the last character, in UNITs, for each wanted window.

    `counts` has window, a (times in accepted URLs) and r (in rejected ones)."""
    grams = _suffixes(counts).groupBy("gram", "context").agg(F.sum("a").alias("a"), F.sum("r").alias("r"))
    contexts = grams.groupBy("context").agg(
        F.sum("a").alias("all_a"), F.sum("r").alias("all_r"), F.sum((F.col("a") > 0).cast("long")).alias("kinds_a"),
        F.sum((F.col("r") > 0).cast("long")).alias("kinds_r"))
    met = _suffixes(wanted).join(grams.drop("context"), "gram", "left").join(contexts, "context", "left")
    fields = [F.coalesce(c, F.lit(0)).cast("double").alias(c) for c in ("a", "r", "all_a", "all_r", "kinds_a", "kinds_r")]
    steps = met.groupBy("window").agg(F.sort_array(F.collect_list(F.struct("order", *fields))).alias("steps"))

    def step(p: Column, s: Column, side: str) -> Column:
        seen, kinds = s[f"all_{side}"], s[f"kinds_{side}"]
        return F.when(seen > 0, (s[side] + kinds * p[side]) / (seen + kinds)).otherwise(p[side]).alias(side)

    chance = F.aggregate("steps", F.struct(F.lit(UNIFORM).alias("a"), F.lit(UNIFORM).alias("r")),
                         lambda p, s: F.struct(step(p, s, "a"), step(p, s, "r")))
    ratio = F.ln(F.col("chance.a")) - F.ln(F.col("chance.r"))
    return steps.select("window", chance.alias("chance")) \
        .select("window", F.floor(ratio * UNIT + 0.5).cast("long").alias("score"))


def threshold(scored: DataFrame) -> DataFrame:
    """One row, column `threshold` in UNITs: the middle of the bin edges with the least sum of the share of
    accepted URLs below and of rejected ones at or above. 0 without URLs of both kinds.

    `scored` has score, a and r (numbers of accepted and rejected URLs); the bins bound what one task sees."""
    bins = scored.groupBy((F.floor(F.col("score") / BIN) * BIN).alias("edge")).agg(F.sum("a").alias("a"), F.sum("r").alias("r"))
    below = Window.orderBy("edge").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    missed = F.try_divide(F.coalesce(F.sum("a").over(below), F.lit(0)), F.sum("a").over(whole)) \
        + F.try_divide(F.sum("r").over(whole) - F.coalesce(F.sum("r").over(below), F.lit(0)), F.sum("r").over(whole))
    errors = bins.select("edge", F.round(missed, 12).alias("missed"))
    least = errors.agg(F.min("missed").alias("least"))
    best = errors.join(F.broadcast(least), F.col("missed") == F.col("least")).agg(F.min("edge").alias("low"), F.max("edge").alias("high"))
    return best.select(F.coalesce(F.floor((F.col("low") + F.col("high")) / 2), F.lit(0)).cast("long").alias("threshold"))


def judge(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict and score of every row."""
    host, path, rest = host_and_path(F.col("url"))
    parts = pages.select("page_id", F.col("url").alias("url"), host.alias("host"), path.alias("path"), shape(rest).alias("shape"))
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    parts = parts.withColumn("rule", rule).withColumn("ruled", verdict)
    left_out = F.md5(F.coalesce("url", F.lit("")).cast("binary")) < FOLD_END
    one = lambda condition: F.sum(F.coalesce(condition, F.lit(False)).cast("long"))
    # All that the models need of the pages, per distinct shape.
    shapes = staged(parts.groupBy("shape").agg(
        one((F.col("ruled") == "allow") & ~left_out).alias("a"), one((F.col("ruled") == "block") & ~left_out).alias("r"),
        one((F.col("ruled") == "allow") & left_out).alias("held_a"),
        one((F.col("ruled") == "block") & left_out).alias("held_r")), "shapes")
    placed = shapes.select("shape", "a", "r", F.explode(_windows(F.col("shape"))).alias("window"))
    counts = staged(placed.groupBy("window").agg(F.sum("a").alias("a"), F.sum("r").alias("r")), "windows")
    scores = staged(window_scores(counts, counts.select("window")), "window_scores")
    table = F.broadcast(scores) if scores.count() <= BROADCAST_WINDOWS else scores
    summed = placed.select("shape", "window").join(table, "window").groupBy("shape").agg(
        F.sum("score").alias("total"), F.count(F.lit(1)).alias("characters"))
    mean = F.floor(F.col("total") / F.col("characters") + 0.5).cast("long")
    scored = staged(summed.select("shape", mean.alias("score"))
                    .join(shapes.select("shape", "held_a", "held_r"), "shape"), "scored_shapes")
    limit = threshold(scored.select("score", F.col("held_a").alias("a"), F.col("held_r").alias("r")))
    # One row: its size is proven.
    judged = scored.select("shape", "score").join(F.broadcast(limit), how="cross")
    by_model = F.when(F.col("score") >= F.col("threshold"), "allow").otherwise("block")
    return parts.join(judged, "shape").select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", by_model).alias("verdict"),
        (F.col("score") / UNIT).alias("score"))


def sql() -> str:
    """The same in DuckDB SQL."""
    cases = " ".join(
        f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN {{{i}}}"
        for i, (_, h, p) in sorted(enumerate(RULES), key=lambda e: -len(e[1][1] + e[1][2])))
    rule = "CASE " + cases.format(*[f"'{h}{p}'" for _, h, p in RULES]) + " END"
    verdict = "CASE " + cases.format(*[f"'{v}'" for v, _, _ in RULES]) + " END"
    upper, lower = string.ascii_uppercase, string.ascii_lowercase
    left_out = f"md5(coalesce(url, '')) < '{FOLD_END}'"
    steps = []
    for j in range(ORDER + 1):
        columns = []
        for side in "ar":
            before = f"{UNIFORM!r}::DOUBLE" if j == 0 else f"w.p{side}{j - 1}"
            columns.append(f"CASE WHEN coalesce(c.n{side}, 0) > 0 THEN (coalesce(g.{side}, 0)::DOUBLE + c.k{side}::DOUBLE * {before})"
                           f" / (c.n{side} + c.k{side})::DOUBLE ELSE {before} END AS p{side}{j}")
        steps.append(f"s{j} AS (SELECT w.*, {', '.join(columns)} FROM {'wins' if j == 0 else f's{j - 1}'} w "
                     f"LEFT JOIN grams g ON g.gram = right(w.win, {j + 1}) "
                     f"LEFT JOIN ctx c ON c.context = left(right(w.win, {j + 1}), {j}))")
    suffixes = " UNION ALL ".join(f"SELECT right(win, {j + 1}) AS gram, left(right(win, {j + 1}), {j}) AS context, a, r FROM wins"
                                  for j in range(ORDER + 1))
    return f"""
WITH u AS (SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
           FROM pages),
h AS (SELECT *, translate(regexp_extract(rest, '^[^/?#]*', 0), '{upper}', '{lower}') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
        regexp_replace(regexp_replace(translate(rest, '{upper}', '{lower}'), '[0-9]', '0', 'g'),
                       '[^a-z0./?=&_%#:-]', '~', 'g') AS shape FROM u),
p AS (SELECT *, {rule} AS rule, {verdict} AS ruled FROM h),
shapes AS (SELECT shape, count(*) FILTER (ruled = 'allow' AND NOT {left_out}) AS a,
        count(*) FILTER (ruled = 'block' AND NOT {left_out}) AS r,
        count(*) FILTER (ruled = 'allow' AND {left_out}) AS held_a,
        count(*) FILTER (ruled = 'block' AND {left_out}) AS held_r FROM p GROUP BY shape),
placed AS (SELECT shape, a, r, substr(padded, i, {ORDER + 1}) AS win FROM (
        SELECT *, unnest(range(1, length(padded) - {ORDER - 1})) AS i FROM (
        SELECT *, '{'^' * ORDER}' || shape || '$' AS padded FROM shapes))),
wins AS (SELECT win, sum(a) AS a, sum(r) AS r FROM placed GROUP BY win),
grams AS (SELECT gram, context, sum(a) AS a, sum(r) AS r FROM ({suffixes}) GROUP BY gram, context),
ctx AS (SELECT context, sum(a) AS na, sum(r) AS nr, count(*) FILTER (a > 0) AS ka, count(*) FILTER (r > 0) AS kr
        FROM grams GROUP BY context),
{", ".join(steps)},
ratios AS (SELECT win, floor((ln(pa{ORDER}) - ln(pr{ORDER})) * {UNIT} + 0.5)::BIGINT AS score FROM s{ORDER}),
scored AS (SELECT shape, floor(sum(score)::DOUBLE / count(*) + 0.5)::BIGINT AS score FROM placed JOIN ratios USING (win)
        GROUP BY shape),
bins AS (SELECT floor(score / {BIN}.0)::BIGINT * {BIN} AS edge, sum(held_a) AS a, sum(held_r) AS r
        FROM scored JOIN shapes USING (shape) GROUP BY 1),
errors AS (SELECT edge, round(coalesce(sum(a) OVER below, 0) / nullif(sum(a) OVER (), 0)::DOUBLE
        + (sum(r) OVER () - coalesce(sum(r) OVER below, 0)) / nullif(sum(r) OVER (), 0)::DOUBLE, 12) AS missed FROM bins
        WINDOW below AS (ORDER BY edge ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
cut AS (SELECT coalesce(floor((min(edge) + max(edge)) / 2.0), 0)::BIGINT AS edge FROM errors
        WHERE missed = (SELECT min(missed) FROM errors))
SELECT page_id, host, path, rule, coalesce(ruled, CASE WHEN score >= edge THEN 'allow' ELSE 'block' END) AS verdict,
       score / {UNIT}::DOUBLE AS score
FROM p JOIN scored USING (shape) CROSS JOIN cut"""
