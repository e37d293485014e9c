"""URL filter: listed rules first, association rules mined by FP-growth for the rest. DataFrame operations only.

A listed rule is a host and the beginning of a path; it fits that host and its subdomains, and of several that fit the longest
wins. The urls that a listed rule decides are the labelled ones (any other labels can be given instead): their tokens - the parts
of the host, the segments of the path with digit runs as 0, the keys of the query - and the label are a transaction. Tokens that occur in
the same labelled urls stand for each other and are one item, so copies of a long url add one item, not all subsets of its tokens.
FP-growth mines the frequent sets, of which those that imply a label with enough confidence are rules. A rule is pruned if
one with fewer items is as confident.

Every distinct set of items meets the rules through an inverted index: a rule stands under its rarest item, the urls look up their items,
and a rule matches if all its items are there. The most confident match decides, then the one with more support, then block before
allow; where none matches, the url is allowed.

Edge cases: NULL url or one without ``://``: host and path are empty, no rule, allowed. A host without path: only rules without a path could
fit it, so none of those ending in ``/``. Repeated rows and ids: judged one by one. No labelled url: no mined rules. Very long urls are
taken whole. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoal.llm.common import materialise

#: The listed rules, host and path, and their verdicts.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
#: Share of the labelled urls that a rule must hold for; share of the urls with its items that must have its label.
SUPPORT, CONFIDENCE = 0.01, 0.8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Labels among the items: tokens start with a letter and a colon.
LABELS = {"block": "=block", "allow": "=allow"}


def _after(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, F.substr(url, at + 3)), F.lit(""))


def host(url: Column) -> Column:
    return F.translate(F.regexp_extract(_after(url), r"^[^/?#]*", 0), UPPER, LOWER)


def path(url: Column) -> Column:
    return F.regexp_extract(_after(url), r"^[^/?#]*([^?#]*)", 1)


def listed(rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest listed rule that fits the columns host and path; NULL if none does."""
    rule = verdict = F.lit(None).cast("string")
    for text, what in sorted(rules, key=lambda r: len(r[0])):
        at = text.find("/") if "/" in text else len(text)
        name, begin = text[:at], text[at:]
        fits = ((F.col("host") == name) | F.endswith(F.col("host"), F.lit(f".{name}"))) & F.startswith(F.col("path"), F.lit(begin))
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def tokens() -> Column:
    """Distinct tokens of the columns url, host and path."""
    def parts(text: Column, by: str, sign: str) -> Column:
        return F.transform(F.filter(F.split(text, by, -1), lambda x: x != ""), lambda x: F.concat(F.lit(sign), x))

    segments = F.regexp_replace(F.translate("path", UPPER, LOWER), "[0-9]+", "0")
    query = F.regexp_extract(_after(F.col("url")), r"^[^?#]*\?([^#]*)", 1)
    keys = F.transform(F.filter(F.split(query, "&", -1), lambda x: x != ""), lambda x: F.concat(F.lit("q:"), F.split(x, "=", 2)[0]))
    return F.array_sort(F.array_distinct(F.concat(parts(F.col("host"), r"\.", "h:"), parts(segments, "/", "p:"), keys)))


def items(learn: DataFrame, bar: int) -> dict[str, str]:
    """{frequent token: item}: tokens of the same labelled urls share an item, their smallest token. At most as many as the average
    url has tokens, divided by SUPPORT."""
    seen = (learn.withColumn("_at", F.xxhash64(F.monotonically_increasing_id())).select("_at", F.explode("tokens").alias("token"))
            .groupBy("token").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("_at").cast("decimal(38,0)")).alias("print"))
            .filter(F.col("n") >= bar))
    classes = seen.groupBy("n", "print").agg(F.min("token").alias("item"), F.collect_list("token").alias("tokens"))
    return {t: r["item"] for r in classes.select("item", "tokens").collect() for t in r["tokens"]}


def mapped(item_of: dict[str, str]) -> Column:
    """Items of the column tokens."""
    if not item_of:
        return F.array().cast("array<string>")
    table = F.map_from_arrays(F.array(*map(F.lit, item_of)), F.array(*map(F.lit, item_of.values())))
    return F.array_sort(F.array_distinct(F.filter(F.transform("tokens", lambda t: F.try_element_at(table, t)), lambda x: x.isNotNull())))


def mine(learn: DataFrame, support: float = SUPPORT, confidence: float = CONFIDENCE) -> tuple[DataFrame, dict[str, str]]:
    """From the stored ``learn`` (tokens, label): pruned rules (items, label, n, m, confidence, key) - ``n`` urls have the items, ``m`` of
    them the label, ``key`` is the rarest item - and the items of the tokens."""
    spark = learn.sparkSession
    total = learn.count()
    bar = max(1, math.ceil(support * total))
    item_of = items(learn, bar) if total else {}
    empty = "items array<string>, label string, n long, m long, confidence double, key string"
    if not item_of:
        return spark.createDataFrame([], empty), item_of
    marks = F.when(F.col("label") == "block", LABELS["block"]).otherwise(LABELS["allow"])
    baskets = learn.select(F.array_append(mapped(item_of), marks).alias("items"))
    sets = materialise(FPGrowth(itemsCol="items", minSupport=support).fit(baskets).freqItemsets.select(F.array_sort("items").alias("items"), "freq"),
                       "url-itemsets")
    labels = F.array(*map(F.lit, LABELS.values()))
    label = F.array_intersect("items", labels)
    plain = sets.filter(F.size(label) == 0).select("items", F.col("freq").alias("n"))
    implied = (sets.filter((F.size(label) == 1) & (F.size("items") > 1))
               .select(F.array_except("items", labels).alias("items"), F.substring(label[0], 2, 9).alias("label"), F.col("freq").alias("m")))
    rare = sets.filter(F.size("items") == 1).select(F.col("items")[0].alias("key"), F.col("freq").alias("f"))
    rules = plain.join(implied, "items").withColumn("confidence", F.col("m") / F.col("n")).filter(F.col("confidence") >= confidence)
    keys = (rules.select("items", F.explode("items").alias("key")).distinct().join(rare, "key")
            .groupBy("items").agg(F.min(F.struct("f", "key"))["key"].alias("key")))
    rules = materialise(rules.join(keys, "items"), "url-rules-all")
    # a rule with more items must be more confident than every one within it
    within = (matches(rules.select("items", "label", "confidence"), rules.select(F.col("items").alias("part"), F.col("label").alias("to"),
                                                                                 F.col("confidence").alias("as_sure"), "key"), "part")
              .filter((F.col("label") == F.col("to")) & (F.size("part") < F.size("items")) & (F.col("as_sure") >= F.col("confidence"))))
    return materialise(rules.join(within.select("items", "label").distinct(), ["items", "label"], "left_anti"), "url-rules"), item_of


def matches(sets: DataFrame, rules: DataFrame, of: str) -> DataFrame:
    """``sets`` (items) with every row of ``rules`` (key, ``of``) whose items ``of`` they all have, by the inverted index on ``key``."""
    return (sets.withColumn("key", F.explode("items")).join(rules, "key")
            .filter(F.size(F.array_except(of, "items")) == 0).drop("key"))


def judge(pages: DataFrame, labels: DataFrame | None = None, carry: tuple[str, ...] = ("page_id",), rules=RULES,
          support: float = SUPPORT, confidence: float = CONFIDENCE) -> DataFrame:
    """``carry`` with host, path, rule, verdict, and confidence and support (labelled urls) of the mined rule that decided, for every row of
    ``pages`` (url). ``labels`` (url, label: block or allow) are learned from; by default the urls that the listed rules decide."""
    def read(df: DataFrame, *keep: str) -> DataFrame:
        return df.select(*keep, "url").select(*keep, "url", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))

    rule, verdict = listed(rules)
    rows = read(pages, *carry).select(*(F.col(c).alias(f"_{i}") for i, c in enumerate(carry)), "host", "path", rule.alias("rule"),
                                      verdict.alias("listed"), tokens().alias("tokens"))
    if labels is None:
        learn = rows.filter("listed is not null").select("tokens", F.col("listed").alias("label"))
    else:
        learn = read(labels, "label").filter(F.col("label").isin(*LABELS)).select(tokens().alias("tokens"), "label")
    mined, item_of = mine(materialise(learn, "url-labels"), support, confidence)
    rows = rows.withColumn("items", mapped(item_of))
    kinds = rows.filter("listed is null and size(items) > 0").select("items").distinct()
    best = F.max(F.struct("confidence", "m", "label"))  # block after allow
    decided = (matches(kinds, mined.withColumnRenamed("items", "part"), "part").groupBy("items").agg(best.alias("best"))
               .select(F.col("items").alias("_items"), "best"))
    mined_only = F.col("listed").isNull()
    return (rows.join(decided, F.col("items") == F.col("_items"), "left")
            .select(*(F.col(f"_{i}").alias(c) for i, c in enumerate(carry)), "host", "path", "rule",
                    F.coalesce("listed", "best.label", F.lit("allow")).alias("verdict"),
                    F.when(mined_only, F.col("best.confidence")).alias("confidence"), F.when(mined_only, F.col("best.m")).alias("support")))


def _listed_sql(rules) -> tuple[str, str]:
    cases = []
    for text, what in sorted(rules, key=lambda r: -len(r[0])):
        at = text.find("/")
        cases.append((f"(host = '{text[:at]}' OR ends_with(host, '.{text[:at]}')) AND starts_with(path, '{text[at:]}')", text, what))
    return tuple("CASE " + " ".join(f"WHEN {c} THEN '{x[i]}'" for c, *x in cases) + " END" for i in (0, 1))


ORACLE = f"""
WITH after AS (
  SELECT row_number() OVER () AS rid, page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS x
  FROM pages),
parsed AS (
  SELECT rid, page_id, x, translate(regexp_extract(x, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host, regexp_extract(x, '^[^/?#]*([^?#]*)', 1) AS path
  FROM after),
judged AS (SELECT *, {_listed_sql(RULES)[0]} AS rule, {_listed_sql(RULES)[1]} AS listed FROM parsed),
token AS (
  SELECT rid, listed, list_distinct(list_concat(
    ['h:' || p for p in string_split(host, '.') if p <> ''],
    ['p:' || p for p in string_split(regexp_replace(translate(path, '{UPPER}', '{LOWER}'), '[0-9]+', '0', 'g'), '/') if p <> ''],
    ['q:' || string_split(p, '=')[1] for p in string_split(regexp_extract(x, '^[^?#]*\\?([^#]*)', 1), '&') if p <> ''])) AS tokens
  FROM judged),
bar AS (SELECT greatest(1, ceil({SUPPORT}::DOUBLE * count(*))) AS bar FROM token WHERE listed IS NOT NULL),
frequent AS (
  SELECT t FROM (SELECT unnest(tokens) AS t FROM token WHERE listed IS NOT NULL) GROUP BY t HAVING count(*) >= (SELECT bar FROM bar)),
item AS (
  SELECT rid, any_value(listed) AS listed, list_sort(list(t)) AS items
  FROM (SELECT rid, listed, unnest(tokens) AS t FROM token) SEMI JOIN frequent USING (t) GROUP BY rid),
part AS (
  SELECT rid, listed, list_filter(items, lambda t, i: ((m >> (i - 1)) & 1) = 1) AS part
  FROM item, unnest(range(1, 1::BIGINT << len(items))) AS s(m)),
rules AS (
  SELECT part, label, m, m / n AS confidence FROM
    (SELECT part, listed AS label, count(*) AS m FROM part WHERE listed IS NOT NULL GROUP BY ALL) JOIN
    (SELECT part, count(*) AS n FROM part WHERE listed IS NOT NULL GROUP BY ALL) USING (part)
  WHERE m >= (SELECT bar FROM bar) AND m / n >= {CONFIDENCE}),
best AS (SELECT rid, max((confidence, m, label)) AS b FROM part JOIN rules USING (part) WHERE listed IS NULL GROUP BY rid)
SELECT page_id, host, path, rule, coalesce(listed, b[3], 'allow') AS verdict, b[1] AS confidence, b[2] AS support
FROM judged LEFT JOIN best USING (rid)
"""
