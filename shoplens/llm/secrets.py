"""Secret scans: candidates by pattern, false positives out by a forest.

A pattern over-collects: any long run of token characters is a candidate, and
any value of 8 characters or more that is assigned to a credential's name. A
random forest, trained on labelled findings, then says from the candidate's
shape (length, kinds of characters, transitions) and its surroundings (path,
word before) which are secrets. What defines the labels of a corpus without
any (key formats, the assigned name, how much of the candidate the corpus's
words cover) is no input of the forest. DataFrame functions and Spark's own forest alone: no Python on
the executors.
"""

from __future__ import annotations

import json
import random

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Run, col

# Names under which credentials are kept.
CREDENTIAL_NAMES = ("access", "api", "auth", "bearer", "client", "credential", "key", "passphrase", "passwd", "password",
                    "private", "pwd", "secret", "session", "signature", "token")
#: Runs of this many token characters, or more, are candidates.
LEAST = 20
_TOKEN = r"[A-Za-z0-9+/_\-]"
#: Values assigned to a credential's name are candidates from this length.
LEAST_VALUE = 8
_ASSIGNED = (rf"(?<=[:=\x20\x09\"'])(?<=[:=][\x20\x09]{{0,4}}[\"']?)(?<=(?i:{'|'.join(CREDENTIAL_NAMES)})[A-Za-z0-9_.\-]{{0,20}}"
             r"[\"']?[\x20\x09]{0,4}[:=][\x20\x09]{0,4}")
_QUOTED_VALUE = rf"{_ASSIGNED}[\"'])[^\x20\x09-\x0D\"'`]{{{LEAST_VALUE},}}"
_BARE = r"\x20\x09-\x0D\"'`,;<>(){}\[\]"
_BARE_VALUE = rf"{_ASSIGNED})[^{_BARE}:=][^{_BARE}]{{{LEAST_VALUE - 2},}}[^{_BARE}.!?:]"
_RUN = rf"{_QUOTED_VALUE}|{_BARE_VALUE}|{_TOKEN}{{{LEAST},}}"
#: Formats that only keys have.
_FORMATS = (r"^(?:(?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|github_pat_\w{22,}|glpat-[\w\-]{20,}|"
            r"[sr]k_(?:live|test)_[A-Za-z0-9]{16,}|sk-[\w\-]{20,}|xox[abprs]-[A-Za-z0-9\-]{10,}|AIza[\w\-]{35}|"
            r"ya29\.[\w\-]{20,}|eyJ[\w\-]{10,}(?:\.[\w\-]+){0,2})$")
_HEX_KEY = r"^(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64}|[0-9A-F]{32}|[0-9A-F]{40}|[0-9A-F]{64})$"
#: What stands before a run: a word, an assigned name with = or :, a quote.
_BEFORE = (r"(?:([^\x20\x09-\x0D]{1,60})[\x20\x09]+)?(?:([A-Za-z0-9_.\-]{1,60})[\"']?[\x20\x09]*[:=][\x20\x09]*)?"
           r"([\"']?)$")
#: Characters before a run that are looked at.
_NEAR = 160
#: What the forest learns from.
FEATURES = ("length", "digit_share", "upper_share", "vowel_share", "hex_share", "kind_changes", "case_changes",
            "distinct_share", "slashes", "in_path", "word_before")
#: What ``weak_labels`` looks at.
EVIDENCE = ("coverage", "covered", "lettered", "assigned", "credential_name", "quoted")


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, body, nth, before, name, quote, candidate, after) of every
    run of token characters, and every value assigned to a credential's name
    (in quotes up to white space or a quote), in every text; body is the text's hash and nth
    the number of the run in it."""
    # Most texts have no such run: they cost one search.
    d = docs.select(col(id_col).alias("doc_id"), col(text_col).alias("text")).filter(F.col("text").rlike(_RUN))
    between = F.split("text", _RUN, -1)  # what stands before, between and after the runs
    found = d.select("doc_id", F.xxhash64("text").alias("body"), F.posexplode(F.arrays_zip(
        F.regexp_extract_all("text", F.lit(_RUN), F.lit(0)).alias("candidate"), between.alias("left"),
        F.slice(between, 2, 2 ** 31 - 2).alias("right"))).alias("nth", "run")).filter("run.candidate is not null")
    near = F.substring("run.left", -_NEAR, _NEAR)
    part = {"before": 1, "name": 2, "quote": 3}
    return (found.select("doc_id", "body", "nth", "run.candidate", near.alias("left"),
                         F.substring("run.right", 1, 1).alias("after"))
            .select("doc_id", "body", "nth", *[F.regexp_extract("left", _BEFORE, k).alias(n) for n, k in part.items()],
                    "candidate", "after"))


def dictionary(docs: DataFrame, share: float = 0.001, text_col: str = "text") -> DataFrame:
    """(piece): the three-letter pieces of the words (2 to 12 letters a-z)
    that at least ``share`` of the texts hold, counted over all texts. There
    are at most 26 ** 3 pieces, whatever the corpus."""
    words = docs.select(F.explode(F.array_distinct(F.split(F.lower(col(text_col)), "[^a-z]+"))).alias("word")).filter(
        F.length("word").between(2, 12))
    counted = words.groupBy("word").agg(F.count(F.lit(1)).alias("texts"))
    least = docs.agg((F.count(col(text_col)) * F.lit(share)).alias("least")).scalar()
    common = counted.filter(F.col("texts") >= least)
    return (common.select(F.explode(_pieces(F.col("word"))).alias("piece")).filter(F.length("piece") == 3).distinct())


def _pieces(word: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.greatest(F.length(word) - 2, F.lit(1))),
                       lambda i: F.substring(word, i, F.lit(3)))


def _share(c: Column, kind: str) -> Column:
    return F.length(F.regexp_replace(c, f"[^{kind}]", "")) / F.length(c)


def _changes(c: Column, pattern: str) -> Column:
    return (F.regexp_count(c, F.lit(pattern)) / F.length(c)).cast("double")


def with_features(found: DataFrame, pieces: DataFrame) -> DataFrame:
    """``found`` (``candidates``) with the columns of ``FEATURES`` and
    ``EVIDENCE``; covered is the share that the dictionary holds of the pieces
    that are letters, lettered the share of such pieces. Equal
    candidates are covered by the dictionary once."""
    c, low = F.col("candidate"), F.lower(F.col("name"))
    texts = found.select("candidate").distinct()
    letters = F.col("piece").rlike("^[a-z]{3}$")
    # At most 26 ** 3 pieces of three letters are sent to every task.
    covered = (texts.select("candidate", F.explode(_pieces(F.lower(F.col("candidate")))).alias("piece"))
               .join(F.broadcast(pieces.withColumn("hit", F.lit(1.0))), "piece", "left")
               .groupBy("candidate").agg(F.avg(F.coalesce("hit", F.lit(0.0))).alias("coverage"),
                                        F.coalesce(F.avg(F.when(letters, F.coalesce("hit", F.lit(0.0)))), F.lit(0.0))
                                        .alias("covered"), F.avg(letters.cast("double")).alias("lettered")))
    named = F.lit(False)
    for word in CREDENTIAL_NAMES:
        named = named | low.contains(word)
    return found.join(covered, "candidate").select(
        *[F.col(x) for x in found.columns], F.length(c).cast("double").alias("length"),
        _share(c, "0-9").alias("digit_share"), _share(c, "A-Z").alias("upper_share"),
        _share(c, "aeiouAEIOU").alias("vowel_share"), _share(c, "0-9a-fA-F").alias("hex_share"),
        _changes(c, "(?<=[0-9])(?=[A-Za-z])|(?<=[A-Za-z])(?=[0-9])").alias("kind_changes"),
        _changes(c, "(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[a-z])").alias("case_changes"),
        (F.size(F.array_distinct(F.split(c, ""))) / F.length(c)).alias("distinct_share"), "coverage", "covered", "lettered",
        F.regexp_count(c, F.lit("/")).cast("double").alias("slashes"),
        F.col("before").rlike(r"[/\\]|://").cast("double").alias("in_path"),
        (F.col("name") != "").cast("double").alias("assigned"), named.cast("double").alias("credential_name"),
        (F.col("quote") != "").cast("double").alias("quoted"),
        F.col("before").rlike("^[A-Za-z]+[.,;:!?]?$").cast("double").alias("word_before"))


def train(findings: DataFrame, sample: int = 5000, trees: int = 40, depth: int = 6, seed: int = 42,
          label_col: str = "secret") -> RandomForestClassificationModel | None:
    """Forest from labelled findings: rows with the columns of ``FEATURES``
    and ``label_col`` (0 or 1; null rows teach nothing). About ``sample``
    rows of each label are learned from, those first by hash. None if there
    are not two labels to tell apart."""
    rows = findings.filter(col(label_col).isNotNull()).withColumn("_label", col(label_col).cast("double"))
    counts = {r["_label"]: r["n"] for r in rows.groupBy("_label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) < 2:
        return None
    spread = 1 << 40
    under = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, int(min(1.0, sample / n) * spread))])
    rows = rows.filter(F.pmod(F.xxhash64("candidate", "doc_id", "nth"), F.lit(spread)) < under[F.col("_label")])
    # In one order, so that the trees' random draws meet the same rows again.
    rows = VectorAssembler(inputCols=list(FEATURES), outputCol="_features").transform(rows).select(
        "_label", "_features", "candidate", "doc_id", "nth").orderBy("candidate", "doc_id", "nth").coalesce(1)
    return RandomForestClassifier(featuresCol="_features", labelCol="_label", numTrees=trees, maxDepth=depth,
                                  seed=seed).fit(rows)


def weak_labels(found: DataFrame) -> DataFrame:
    """Labels for corpora that come without any, by evidence that the forest
    does not see: a run in a format that only keys have, wherever it stands,
    or of as many hex digits as keys have and assigned to a credential's name,
    is a finding (1); one that the corpus's words cover is not (0). Others,
    random-looking bare runs among them, stay unlabelled."""
    c = F.col("candidate")
    yes = c.rlike(_FORMATS) | ((F.col("credential_name") == 1) & c.rlike(_HEX_KEY))
    no = (F.col("covered") >= 0.8) & (F.col("lettered") >= 0.4)
    return found.withColumn("secret", F.when(yes, 1).when(no, 0))


def examples(spark: SparkSession, each: int = 40, seed: int = 42) -> DataFrame:
    """Made-up findings as ``candidates`` returns them, and ``secret``: keys
    and passwords of many shapes (1), and identifiers, paths and words (0),
    so that a forest does not know the one shape of keys in a corpus alone."""
    rng = random.Random(seed)
    lower, upper, digits = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    some = lambda chars, *n: "".join(rng.choice(chars) for _ in range(rng.choice(n)))
    words = ("user account request get set find default config service value name path file image data manager handler "
             "public local share library application content type number field update create session password token "
             "example change your here production department organization international something important").split()
    rows = []
    for _ in range(each):
        rows += [(1, x) for x in (
            some("0123456789abcdef", 16, 32, 40, 64), some("0123456789ABCDEF", 32, 40), "AKIA" + some(upper + digits, 16),
            "ghp_" + some(lower + upper + digits, 36), "sk_live_" + some(lower + upper + digits, 24),
            some(lower + upper + digits, 20, 32, 40, 48), some(lower + upper + digits + "+/", 28, 40, 64),
            some(lower + digits, 20, 32, 40), some(lower + upper + digits + "-_", 22, 43),
            some(lower + upper + digits + "!@#$%.~", 10, 12, 16),
            "".join({"e": "3", "o": "0", "a": "4", "i": "1"}.get(x, x) for x in rng.choice(words).title()) + some("!@#$%.~", 1)
            + "".join({"e": "3", "o": "0", "a": "@"}.get(x, x) for x in rng.choice(words).title()) + some(digits, 1, 2))]
        for glue in ("", "-", "_", "/", ".", "camel"):
            for n in (1, 2, 4):
                parts = [rng.choice(words) for _ in range(n)]
                rows.append((0, "".join(x.title() for x in parts) if glue == "camel" else
                             rng.choice(["", "/"]) * (glue == "/") + glue.join(parts)))
    # One literal of JSON: a thousand structs of literals take Spark longer to plan than to read.
    made = [{"secret": y, "candidate": x, "before": rng.choice(["", "is", "=", "with"]), "doc_id": -k}
            for k, (y, x) in enumerate(rows)]
    made = F.from_json(F.lit(json.dumps(made)), "array<struct<secret:int,candidate:string,before:string,doc_id:bigint>>")
    return spark.range(1).select(F.explode(made).alias("e")).select(
        "e.*", F.lit(0).cast("long").alias("body"), F.lit(0).alias("nth"), F.lit("").alias("name"), F.lit("").alias("quote"),
        F.lit("").alias("after"))


def scan_secrets(docs: DataFrame, findings: DataFrame | None = None, least: float = 0.5, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per candidate of every row of ``docs``: doc_id, nth (its number
    among the text's candidates), name (assigned name or empty), candidate,
    probability and secret (probability of at least ``least``).

    ``findings`` are labelled rows (candidates with their surroundings as
    ``candidates`` returns them, and ``secret``); without them the candidates
    of ``docs`` get ``weak_labels``, and the forest also learns from
    ``examples``. A bare digest (of a commit or file) looks like a key and
    counts as a secret. Where labels do not tell two kinds apart,
    the probability is null and every candidate counts as a secret.

    Null and empty texts have no candidates. Equal rows get equal rows; extra
    columns are ignored; an empty table gives no rows."""
    run = Run(docs.sparkSession, "secrets")
    pieces = run.stage(dictionary(docs, text_col=text_col), "pieces")
    found = run.stage(with_features(run.stage(candidates(docs, id_col, text_col), "candidates"), pieces), "features")
    if findings is None:
        known = weak_labels(found)
        if known.agg(F.count_distinct("secret")).first()[0] == 2:
            known = known.unionByName(with_features(examples(docs.sparkSession), pieces))
    else:
        known = with_features(findings.drop("secret"), pieces).join(
            findings.select("doc_id", "nth", "candidate", "secret"), ["doc_id", "nth", "candidate"])
    forest = train(known)
    if forest is None:
        probability = F.lit(None).cast("double")
        out = found.withColumn("probability", probability)
    else:
        scored = forest.transform(VectorAssembler(inputCols=list(FEATURES), outputCol="_features").transform(found))
        out = scored.withColumn("probability", vector_to_array("probability")[1])
    return out.select("doc_id", F.col("nth").cast("long").alias("nth"), "name", "candidate", "probability",
                      F.coalesce(F.col("probability") >= least, F.lit(True)).alias("secret"))
