"""URL filter: listed host and path rules, and association rules mined from labels.

DataFrame functions and Spark ML's FP-growth only.

* A listed rule fits its host and all subdomains where the path starts with the rule's
  path; the longest fitting rule decides. The list is a parameter (at most
  ``MOST_LISTED`` rules), so it becomes one expression in the scan: no join, no shuffle.
* URLs become sets of tokens (scheme, host labels, path words, query keys, fragment).
  Tokens that the same labelled URLs hold are one class, as they lead to the same rules. A
  class that passes the pruning alone is a rule, and no part of longer ones, which would
  fit no further URL. FP-growth mines the combinations of the other classes; rules
  "classes -> block" with enough confidence and support are kept. The verdicts are those of
  all rules over single tokens, without the sets that only repeat each other.
* An inverted index holds every rule under the tokens of its rarest class. URL tokens meet
  the index in an equi-join, the rule's other classes are then checked on the row. A URL
  without a listed rule is blocked if an association rule fits, else allowed.

A URL that is null or has no ``://`` has empty host and path, fits no listed rule and
has no tokens (allow). Label rows of unknown URLs and null labels are left out; with
no labels there are no mined rules. Repeated rows are judged alike, empty tables give
no rows, other columns are ignored.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored, table

#: fixed values of the contract: (verdict, host, path)
LISTED = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
          ("block", "net", "/es/"), ("block", "net", "/fr/")]
MOST_LISTED = 500
#: pruning of mined rules: share of labelled URLs (and rows at least), confidence, lift
SUPPORT, LEAST_ROWS, CONFIDENCE, LIFT = 0.002, 10, 0.7, 1.5
#: an index of up to this many tokens (20 bytes each, about) is broadcast, beyond it it is shuffled
BROADCAST_TOKENS = 200_000
_BLOCKED = "label=block"


def _lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_parts(url: str) -> tuple[Column, Column, Column]:
    """(host, path, what follows the path) of a URL column."""
    text = F.coalesce(F.col(url).cast("string"), F.lit(""))
    at = F.instr(text, "://")
    rest = F.when(at > 0, F.substr(text, at + 3)).otherwise("")
    host = _lower(F.regexp_extract(rest, r"^([^/?#]*)", 1))
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.regexp_extract(rest, r"(?s)([?#].*)$", 1)


def listed_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """(rule, verdict) of the longest fitting rule, null where none fits."""
    if len(rules) > MOST_LISTED:
        raise ValueError(f"at most {MOST_LISTED} listed rules")
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        found = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"),
                                      F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def url_tokens(url: str) -> Column:
    """Distinct tokens of a URL: what it says, not its numbers."""
    host, path, tail = url_parts(url)
    text = F.coalesce(F.col(url).cast("string"), F.lit(""))

    def marked(kind: str, words: Column) -> Column:
        some = F.filter(words, lambda w: (w != "") & ~w.rlike("^[0-9]+$"))
        return F.transform(some, lambda w: F.concat(F.lit(kind), w))

    scheme = F.when(F.instr(text, "://") > 0, _lower(F.regexp_extract(text, r"^([A-Za-z][A-Za-z0-9+.\-]*)://", 1)))
    return F.array_distinct(F.concat(
        marked("scheme=", F.array(F.coalesce(scheme, F.lit("")))),
        marked("host=", F.split(host, r"[.\-]")), marked("path=", F.split(_lower(path), r"[/.\-_]")),
        marked("query=", F.transform(F.split(F.regexp_extract(tail, r"\?([^#]*)", 1), "&"),
                                     lambda p: F.split(p, "=")[0])),
        marked("fragment=", F.array(F.regexp_extract(tail, r"#(.*)$", 1)))))


def mine_rules(labelled: DataFrame, support: float = SUPPORT, confidence: float = CONFIDENCE,
               lift: float = LIFT) -> DataFrame:
    """Pruned rules (antecedent, confidence, keys): from (tokens, label) rows, label 1 = block.

    A rule's antecedent is a list of token classes, of which a URL needs one token each;
    ``keys`` are the tokens of its rarest class.
    """
    spark = labelled.sparkSession
    rows = stored(spark, labelled.where(F.col("label").isin(0, 1) & (F.size("tokens") > 0))
                  .select(F.monotonically_increasing_id().alias("row"), F.col("label").cast("int").alias("label"),
                          F.array_distinct("tokens").alias("tokens")), "url-labelled")
    total, blocked = rows.agg(F.count("*"), F.sum("label")).first()
    schema = "antecedent array<array<string>>, confidence double, keys array<string>"
    if not blocked:
        return spark.createDataFrame([], schema)
    least = max(support * total, LEAST_ROWS)
    each = rows.select("row", "label", F.explode("tokens").alias("token")).groupBy("token").agg(
        F.count("*").alias("n"), F.sum("label").alias("bad"),
        F.struct(F.bit_xor(F.xxhash64("row")), F.bit_xor(F.xxhash64("row", F.lit(1)))).alias("held_by"))
    classes = stored(spark, each.where((F.col("n") >= least) & (F.col("n") < total)).groupBy("held_by", "n", "bad")
                     .agg(F.sort_array(F.collect_list("token")).alias("members"))
                     .select(F.element_at("members", 1).alias("item"), "members", "n",
                             (F.col("bad") / F.col("n")).alias("confidence")), "url-classes")
    strong = (F.col("confidence") >= confidence) & (F.col("confidence") / (blocked / total) >= lift)
    alone = classes.where(strong).select(F.array("members").alias("antecedent"), "confidence",
                                         F.col("members").alias("keys"))
    weak = classes.where(~strong).select("item", "members", "n")
    # what passes alone says no more together with others; equal row sets count once
    baskets = (rows.select("row", "label", F.explode("tokens").alias("item")).join(weak.select("item"), "item")
               .groupBy("row", "label").agg(F.collect_list("item").alias("items"))
               .select(F.concat("items", F.array(F.when(F.col("label") == 1, _BLOCKED).otherwise("label=allow")))
                       .alias("items")))
    filled = baskets.count()
    if not filled:
        return alone
    model = FPGrowth(itemsCol="items", minSupport=min(1.0, least / filled),
                     minConfidence=confidence).fit(baskets)
    rules = model.associationRules.where((F.element_at("consequent", 1) == _BLOCKED)
                                         & (F.col("confidence") / (blocked / total) >= lift)
                                         & ~F.exists("antecedent", lambda t: t.startswith("label=")))
    rules = rules.select(F.sort_array("antecedent").alias("items"), "confidence")
    joint = (rules.select("items", "confidence", F.explode("items").alias("item")).join(weak, "item")
             .groupBy("items", "confidence").agg(F.collect_list("members").alias("antecedent"),
                                                 F.min_by("members", F.struct("n", "item")).alias("keys"))
             .select("antecedent", "confidence", "keys"))
    return alone.unionByName(joint)


def judge_urls(spark: SparkSession, pages: DataFrame, mined: DataFrame, id_col: str = "page_id",
               url_col: str = "url", rules: list[tuple[str, str, str]] = LISTED) -> DataFrame:
    """One row per row of ``pages``: id, host, path, rule, verdict, confidence."""
    host, path, _ = url_parts(url_col)
    rows = stored(spark, pages.select(
        F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"), host.alias("host"),
        path.alias("path"), listed_rule(host, path, rules).alias("listed"),
        url_tokens(url_col).alias("tokens")), "url-tokens")
    mined = stored(spark, mined, "url-rules")
    index = mined.select("antecedent", "confidence", F.explode("keys").alias("key"))
    size = mined.agg(F.sum(F.size(F.flatten("antecedent")) * F.size("keys"))).first()[0] or 0
    index = F.broadcast(index) if size <= BROADCAST_TOKENS else index
    open_ = rows.where("listed IS NULL").select("row", "tokens", F.explode("tokens").alias("key"))
    hits = (open_.join(index, "key")
            .where(F.forall("antecedent", lambda members: F.arrays_overlap(members, F.col("tokens"))))
            .groupBy("row").agg(F.max("confidence").alias("confidence")))
    return (rows.join(hits, "row", "left")
            .select(F.col("id").alias(id_col), "host", "path", F.col("listed.rule").alias("rule"),
                    F.coalesce("listed.verdict", F.when(F.col("confidence").isNotNull(), "block")
                               .otherwise("allow")).alias("verdict"), "confidence"))


def document_number(url: str) -> Column:
    """The number that ends the path of a URL (before an extension), the page's document; else null."""
    return F.regexp_extract(url_parts(url)[1], r"/([0-9]+)(?:\.[A-Za-z0-9]+)?/?$", 1).try_cast("long")


def labelled_urls(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(tokens, label) of the pages whose document has labels: bad quality or toxic is 1."""
    marks = (labels.where("quality IS NOT NULL AND toxic IS NOT NULL")
             .groupBy(F.col("doc_id").cast("long").alias("number"))
             .agg(F.max(((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int")).alias("label")))
    return (pages.withColumn("number", document_number("url")).join(marks, "number")
            .select(url_tokens("url").alias("tokens"), "label"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of the table ``labels`` stand for the pages of their document, by the number in the URL's path."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    mined = mine_rules(labelled_urls(pages, table(spark, sf_dir, "labels")))
    return judge_urls(spark, pages, mined).drop("confidence")
