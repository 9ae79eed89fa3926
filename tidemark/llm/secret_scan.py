"""Secret scan: pattern candidates, false positives removed by a random forest.

DataFrame and SQL functions and Spark ML only.

Candidates are all values assigned to a credential word (quoted or not, any length) or
standing before the host of a URL, long runs of key-like characters with a digit, and
quoted values that are assigned to something. A NAME= in front is no part of the value.
Every candidate of every text gets

* length, share of digits, capitals and distinct characters, all-hexadecimal;
* character transitions: mean log probability of its neighbouring characters under
  the transitions of the corpus's own words;
* dictionary coverage: share of its characters in words that the corpus uses
  ``WORD_SEEN`` times or more;
* path: slashes, dots, an ``@`` or a slash before it;
* neighbouring words: whether it is assigned or quoted, whether the word before names
  a credential, and how often labelled findings after that word were secrets.

The corpus counts (words, transitions) cover all texts. The forest is fitted on
labelled findings, at most about ``FIT_FINDINGS`` of them, and decides on every finding;
only without findings of both labels the label rule does. ``label_findings`` labels
findings whose form leaves no doubt, for the fit: a random value assigned to a credential
name is a secret; digits only, addresses, host names and paths that are not assigned to one
are not, nor are unquoted usual words.

Values, and the text next to them, are encrypted in every table that is stored on the
way, by a key that lives as long as the scan.

Null and empty texts have no candidates. Repeated rows have the same findings each.
Empty tables give no rows; other columns are left alone. Positions are code points
from 0.
"""

from __future__ import annotations

import math
import secrets

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import fresh, stored, table

_NAMES = (r"(?:token|secret|passw(?:or)?d|passphrase|passcode|(?<![A-Za-z])pass|pwd|auth|bearer|credential"
          r"|(?:api|access|private|secret|signing|encryption|account|client)[_-]?key)s?[_-]?[0-9]{0,3}")
CREDENTIAL = f"(?i){_NAMES}$"
#: in front of a value that is assigned to a credential word; the first two only save time
_ASSIGNED = (r"(?<=[=:>\s\"'])(?<=[=:]>?\s{0,8}[\"']?)"
             rf"(?<=(?i:{_NAMES})[\"']?\s{{0,8}}[=:]{{1,2}}>?\s{{0,8}}[\"']?)")
#: where an unquoted value ends: white space, the punctuation before it, a closing quote, the next NAME=
_STOP = r"\s|[\"'](?!\w)|[&,;]\s?\w{1,40}=|[.,;:)\]}>]{1,8}(?:[\"']|\s|\z)"
#: a value assigned to a credential word or in front of a URL's host, of any length, quoted or not; else a run of
#: 16 or more key characters with a digit (8 after NAME=, which is no part of it), or an assigned quoted value
CANDIDATE = (rf"{_ASSIGNED}(?:(?<=\")(?:[^\"\\\r\n]|\\.)++(?=\")|(?<=')(?:[^'\\\r\n]|\\.)++(?=')"
             rf"|(?![=:>\"'])(?:(?!{_STOP}).)++)"
             r"|(?<=:)(?<=://[^\s/:@\"']{0,64}:)[^\s/\"']+(?=@)|(?<=://)[^\s/:@\"']++(?=@|:[^\s/\"']*@)"
             r"|(?<![A-Za-z0-9+/_.\-])(?!//[^\s/\"']*@)(?=[A-Za-z+/_.\-]{0,400}+[0-9])"
             rf"(?![A-Za-z0-9_.\-]{{0,60}}(?i:{_NAMES})[\"']?\s{{0,8}}[=:])"  # the name of a secret
             r"(?:(?=[A-Za-z0-9+/_=.\-]{16})|(?<=[A-Za-z0-9_\-]=)(?=[A-Za-z0-9+/_.\-]{8}))"
             r"[A-Za-z0-9+/_.\-]{8,}+(?:={1,2}(?![A-Za-z0-9+/_=.\-]))?"
             rf"|(?<=[=:]\s{{0,8}}[\"'])(?![^\s\"']{{0,300}}?(?:(?i:{_NAMES})[=:]|://[^\s/\"']*@))[^\s\"']{{8,}}(?=[\"'])")
#: characters of context on either side from which neighbouring words are taken
CONTEXT = 48
WORD_SEEN = 20
FIT_FINDINGS = 20_000
TREES, DEPTH, SEED = 24, 6, 7
MASK = "[REDACTED]"
#: what identifies a finding: it and the text next to it
VALUE = ("value", "before", "after")
FEATURES = ["length", "digits", "capitals", "distinct", "hex", "transitions", "coverage", "path",
            "before_at", "assigned", "quoted", "credential", "before_rate"]


def _text(col: str) -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def _matches(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0))


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, row, idx, digest, start, value, before, after), one row per candidate."""
    text = docs.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"),
                       _text(text_col).alias("text"))
    found = text.withColumn("values", _matches(F.col("text"))).where(F.size("values") > 0)
    parts = found.select("id", "row", F.sha2("text", 256).alias("digest"), "values",
                         F.split("text", CANDIDATE, -1).alias("gaps"))
    def ahead(g: Column, i: Column) -> Column:  # the name may be in a candidate just before
        last = F.when(i > 0, F.concat(F.right(F.get("gaps", i - 1), F.lit(CONTEXT)), F.get("values", i - 1)))
        return F.right(F.concat(F.coalesce(last, F.lit("")), g), F.lit(CONTEXT))

    spread = F.transform(F.slice("gaps", F.lit(1), F.size("values")),
                         lambda g, i: F.struct(F.length(g).alias("gap"), ahead(g, i).alias("before")))
    zipped = F.zip_with(spread, "values", lambda g, v: F.struct(g["gap"].alias("gap"), v.alias("value"),
                                                                g["before"].alias("before")))
    each = parts.select("id", "row", "digest", F.transform(F.slice("gaps", F.lit(2), F.size("values")),
                                                           lambda g: F.left(g, F.lit(CONTEXT))).alias("after"),
                        zipped.alias("found"))
    both = F.zip_with("found", "after", lambda f, a: F.struct(f["gap"].alias("gap"), f["value"].alias("value"),
                                                             f["before"].alias("before"), a.alias("after")))
    return (each.select("id", "row", "digest", F.posexplode(both).alias("idx", "f"))
            .select("id", "row", "digest", "idx", "f.*"))


def _sealed(spark: SparkSession, df: DataFrame, label: str, *hidden: str) -> DataFrame:
    """``df`` stored with the ``hidden`` columns encrypted, and read back."""
    key = F.unhex(F.lit(secrets.token_hex(16)))
    kept = stored(spark, df.withColumns({c: F.aes_encrypt(F.col(c), key) for c in hidden}), label)
    return kept.withColumns({c: F.aes_decrypt(F.col(c), key).cast("string") for c in hidden})


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(word, n): lower-case letter runs of all texts."""
    words = docs.select(F.explode(F.split(F.lower(_text(text_col)), r"[^\p{L}]+")).alias("word"))
    return words.where("word != ''").groupBy("word").agg(F.count("*").alias("n"))


def transitions(counts: DataFrame) -> DataFrame:
    """(pair, logp) over a-z and 0-9: how likely the second character follows the first.

    At most 36 * 36 rows. Digits follow and precede anything with the smoothing mass.
    """
    ends = F.sequence(F.lit(1), F.length("word") - 1)
    pairs = (counts.where(F.length("word") > 1)
             .select("n", F.explode(F.transform(ends, lambda i: F.substr("word", i, F.lit(2)))).alias("pair"))
             .where(F.col("pair").rlike("^[a-z]{2}$"))
             .groupBy("pair").agg(F.sum("n").alias("n")))
    firsts = pairs.groupBy(F.left("pair", F.lit(1)).alias("first")).agg(F.sum("n").alias("total"))
    return (pairs.join(F.broadcast(firsts), F.left("pair", F.lit(1)) == F.col("first"))
            .select("pair", F.log((F.col("n") + 0.5) / (F.col("total") + 18)).alias("logp")))


def _share(value: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(value, pattern, "")) / F.length(value)


def described(found: DataFrame, counts: DataFrame) -> DataFrame:
    """Features of the distinct (value, before, after), all but ``before_rate``."""
    value = F.col("value")
    near = F.regexp_extract(F.col("before"), r"(?U)(\w+(?:-\w+)*)\W*$", 1)
    password = F.col("before").rlike(rf"(?:://[^\s/@]*|^[^\s/@]{{{CONTEXT - 1}}}):$")
    userinfo = F.col("after").rlike("^@") & (password | F.col("before").rlike("://$") & (F.length(value) >= 16))
    seen = found.groupBy("value", "before", "after").agg(F.lit(1).alias("one")).drop("one")
    seen = seen.select("*", F.lower(near).alias("word_before"),
                       F.length(value).cast("double").alias("length"),
                       _share(value, "[^0-9]").alias("digits"), _share(value, "[^A-Z]").alias("capitals"),
                       (F.size(F.array_distinct(F.split(value, ""))) / F.length(value)).alias("distinct"),
                       value.rlike("^[0-9a-fA-F]+$").cast("double").alias("hex"),
                       (F.length(F.regexp_replace(value, r"[^/.]", "")) / F.length(value)).alias("path"),
                       (F.col("before").rlike("[@/]$") & ~userinfo).cast("double").alias("before_at"),
                       (F.col("before").rlike(r"[=:]>?\s*[\"']?$") | userinfo).cast("double").alias("assigned"),
                       (F.col("before").rlike("[\"']$") & F.col("after").rlike("^[\"']"))
                       .cast("double").alias("quoted"),
                       (near.rlike(CREDENTIAL) | userinfo).cast("double").alias("credential"))
    # transitions and dictionary coverage depend on the value alone
    values = seen.select("value").distinct()
    low = F.lower("value")
    pairs = values.select("value", F.explode(F.transform(F.sequence(F.lit(1), F.length("value") - 1),
                                                         lambda i: F.substr(low, i, F.lit(2)))).alias("pair"))
    moves = (pairs.where(F.col("pair").rlike("^[a-z0-9]{2}$"))
             .join(F.broadcast(transitions(counts)), "pair", "left")
             .groupBy("value").agg(F.avg(F.coalesce("logp", F.lit(math.log(1e-4)))).alias("transitions")))
    words = values.select("value", F.explode(F.split(low, r"[^\p{L}]+")).alias("word")).where(F.length("word") > 1)
    usual = counts.where(F.col("n") >= WORD_SEEN).select("word")
    covered = (words.join(usual, "word").groupBy("value").agg(F.sum(F.length("word")).alias("chars")))
    return (seen.join(moves, "value", "left").join(covered, "value", "left")
            .withColumn("transitions", F.coalesce("transitions", F.lit(0.0)))
            .withColumn("coverage", F.coalesce(F.col("chars") / F.length("value"), F.lit(0.0))).drop("chars"))


def label_findings(features: DataFrame) -> DataFrame:
    """``features`` with ``label`` 1.0 or 0.0 where the form leaves no doubt, else null."""
    random = (F.col("digits") > 0.1) & (F.col("digits") < 0.95) & (F.col("coverage") < 0.5)
    host = F.col("value").rlike(r"^[A-Za-z0-9\-]+(\.[A-Za-z0-9\-]+)+\.?$") & (F.col("assigned") == 0)
    given = (F.col("credential") == 1) & (F.col("assigned") == 1)
    prose = (F.col("coverage") == 1) & (F.col("quoted") == 0)
    return features.withColumn(
        "label", F.when(given & random, 1.0).when(given & ~prose, F.lit(None).cast("double"))
        .when(prose | (F.col("digits") == 1) | (F.col("before_at") == 1) | host, 0.0))


def _rates(labelled: DataFrame) -> DataFrame:
    return labelled.groupBy("word_before").agg(
        ((F.sum("label") + 0.5) / (F.count("*") + 1.0)).alias("before_rate"))


def judged(spark: SparkSession, found: DataFrame, counts: DataFrame,
           labelled: DataFrame | None = None) -> DataFrame:
    """(value, before, after, probability) of the distinct findings.

    ``labelled``: findings as ``described`` gives them with a ``label``; by default
    those that ``label_findings`` can label.
    """
    features = _sealed(spark, label_findings(described(found, counts)), "secret-features", *VALUE, "word_before")
    known = (features if labelled is None else labelled).where("label IS NOT NULL")
    sizes = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    share = min(1.0, FIT_FINDINGS / max(sum(sizes.values()), 1))
    picked = _sealed(spark, known.where(F.pmod(F.xxhash64("value", "before"), F.lit(1_000_000))
                                        < int(share * 1_000_000)), "secret-fit", *VALUE, "word_before")
    if set(sizes) != {0.0, 1.0} or picked.select("label").distinct().count() < 2:
        return features.select("value", "before", "after", F.coalesce("label", F.lit(0.0)).alias("probability"))
    rates = F.broadcast(_rates(picked))  # at most as many rows as findings are picked
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="vector")

    def vectors(rows: DataFrame) -> DataFrame:
        rated = rows.join(rates, "word_before", "left")
        return assembler.transform(rated.withColumn("before_rate", F.coalesce("before_rate", F.lit(0.5))))

    forest = RandomForestClassifier(featuresCol="vector", labelCol="label", numTrees=TREES, maxDepth=DEPTH,
                                    seed=SEED, probabilityCol="chance", rawPredictionCol="votes",
                                    predictionCol="vote", minInstancesPerNode=2)
    model = forest.fit(vectors(picked))
    return model.transform(vectors(features)).select("value", "before", "after",
                                                     vector_to_array("chance")[1].alias("probability"))


def scan_secrets(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 labelled: DataFrame | None = None) -> DataFrame:
    """One row per candidate: id, row, idx, digest, start, length, value, probability, is_secret."""
    found = _sealed(spark, candidates(docs, id_col, text_col), "secret-candidates", *VALUE)
    counts = stored(spark, word_counts(docs, text_col), "secret-words")
    verdict = _sealed(spark, judged(spark, found, counts, labelled), "secret-verdicts", *VALUE)
    earlier = Window.partitionBy("row").orderBy("idx")
    placed = found.select("*", (F.sum(F.col("gap") + F.length("value")).over(earlier)
                                - F.length("value")).alias("start"))
    return (placed.join(verdict, ["value", "before", "after"])
            .select("id", "row", "idx", "digest", "start", F.length("value").alias("length"), "value",
                    "probability", (F.col("probability") >= 0.5).alias("is_secret")))


def redact(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           mask: str = MASK, size_col: str = "n_chars") -> DataFrame:
    """``docs`` with each secret replaced by ``mask``; ``size_col``, if there, follows the text.

    Findings depend on the text alone, so verdicts come back by the text's digest;
    only documents with candidates take part in that join.
    """
    found = stored(spark, scan_secrets(spark, docs, id_col, text_col).where("is_secret")
                   .select("digest", "idx").distinct(), "secret-findings")
    bad = (found.groupBy("digest").agg(F.collect_list("idx").alias("bad")))
    values, digest, hits = fresh(docs, "values", "digest", "bad")
    marked = docs.withColumn(values, _matches(_text(text_col)))
    clean = marked.where(F.size(values) == 0).select(*docs.columns)
    open_ = marked.where(F.size(values) > 0).withColumn(digest, F.sha2(_text(text_col), 256))
    bad = bad.select(F.col("digest").alias(digest), F.col("bad").alias(hits))
    joined = open_.join(bad, digest, "left").withColumn(hits, F.coalesce(hits, F.array().cast("array<int>")))
    gaps = F.split(F.col(text_col), CANDIDATE, -1)
    shown = F.transform(values, lambda v, i: F.when(F.array_contains(hits, i), F.lit(mask)).otherwise(v))
    text = F.array_join(F.zip_with(gaps, shown, lambda g, v: F.concat(g, F.coalesce(v, F.lit("")))), "")
    masked = joined.withColumn(text_col, F.when(F.size(hits) > 0, text).otherwise(F.col(text_col)))
    if size_col in docs.columns:
        kind = docs.schema[size_col].dataType
        masked = masked.withColumn(size_col, F.when(F.size(hits) > 0, F.length(text_col).cast(kind))
                                   .otherwise(F.col(size_col)))
    return clean.unionByName(masked.select(*docs.columns))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(spark, table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "start", "length", F.sha2("value", 256).alias("value_sha256"),
                        F.round("probability", 6).alias("probability"), "is_secret")
