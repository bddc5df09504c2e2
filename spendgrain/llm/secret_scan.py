"""Secret scan: candidates by pattern, then a random forest that removes false positives.

Candidates are runs of characters of keys and tokens, any number in a word: ten or more with a digit among them, or six or more that
are assigned to a name that speaks of a secret, in the same word or after it; or sixteen or more behind such a name alone. In a
word with :// a slash ends a run. The forest judges each
by its length, by transitions between kinds of characters, by how much of it plain words cover, by the
path it was found under and by the words beside it. It is trained from labelled findings: a bounded
sample of candidates with a label. Without labels of both kinds nothing can be learned, so that every
candidate counts as a secret with score 0.5.

Defined results: NULL and empty texts have no candidates. Documents with the same id keep their own
findings, since rows are not joined by id. Repeated rows give repeated findings. An empty table gives no
rows. A very long text is split into words whole, in one row. Other columns are not looked at by `scan`, and passed through by `redact`,
which masks a secret's value wherever it stands as a whole run of such characters.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendgrain.llm.common import any_of, cut

#: Names that are given to secrets, and to other long values. Fixed values.
SECRET_NAMES = ("token", "secret", "password", "passwd", "pwd", "apikey", "api_key", "access_key", "auth", "bearer", "credential", "private")
OTHER_NAMES = ("phone", "tel", "fax", "card", "iban", "isbn", "order", "invoice", "sha", "commit", "uuid", "version", "page", "ip")
#: Plain words; what they cover of a candidate is not random. Fixed values.
PLAIN = ("the", "and", "ing", "tion", "ent", "ment", "der", "die", "und", "ung", "que", "les", "ado", "con", "mail", "example", "com", "org", "net", "www", "http", "test", "page", "html", "version", "file", "index", "item", "user", "name")
#: Parts of a path that speak against a secret. Fixed values.
TEST_PATHS = ("test", "example", "mock", "sample", "doc")

VALUE = r"[A-Za-z0-9+/_\-]{6,}={0,2}"
LONG = r"(?=[^\s]*[0-9])[A-Za-z0-9+/_\-=]{10,}"
ASSIGNED = rf"(?i)(?:{any_of(SECRET_NAMES)})[A-Za-z0-9_\-]*[\"']?[=:][\"']?{VALUE}"
#: A run with the name that it is assigned to, if there is one.
RUN = rf"(?:[A-Za-z][A-Za-z0-9_.\-]*[\"']?[=:][\"']?)?{VALUE}"
FEATURES = ["length", "switches", "case_switches", "digits", "plain", "test_path", "depth", "secret_near", "other_near", "assigned", "quoted"]
MASK = "<SECRET>"


def candidates(documents: DataFrame, path: str = "source") -> DataFrame:
    """doc_id, path, place (of the word in the text, from 0), name (what the value is assigned to in the word, with the sign), value, and
    the words beside it."""
    names = any_of(SECRET_NAMES)
    words = F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+")
    rows = documents.select("doc_id", F.col(path).alias("path"), words.alias("words"))

    def beside(place: Column, k: int) -> Column:
        return F.coalesce(F.get(F.col("words"), place + k), F.lit(""))

    def named_before(word: Column, before: Column, before2: Column) -> Column:
        """Whether the words before assign this one to a secret's name, or are such a name themselves."""
        assigned = before.rlike(rf"(?i)(?:{names})[\"']?[=:][\"']?$") | (before.isin("=", ":", ":=", "=>") & before2.rlike(rf"(?i)(?:{names})[\"']?$"))
        return assigned | ((F.length(word) >= 16) & before.rlike(rf"(?i)^[\"']?(?:{names})$"))

    found = F.transform(
        F.filter(
            F.transform("words", lambda w, i: F.struct(w.alias("word"), i.alias("place"))),
            lambda x: (F.length(x["word"]) >= 6)
            & (x["word"].rlike(LONG) | x["word"].rlike(ASSIGNED) | named_before(x["word"], beside(x["place"], -1), beside(x["place"], -2))),
        ),
        lambda x: F.struct(
            x["place"].alias("place"), x["word"].alias("word"), *[beside(x["place"], k).alias(n) for n, k in (("before2", -2), ("before", -1), ("after", 1))]
        ),
    )
    rows = rows.select("doc_id", "path", F.inline(found))
    in_url = F.col("word").contains("://")
    run = F.when(in_url, F.regexp_extract_all("word", F.lit(RUN.replace("+/_", "+_")), F.lit(0))).otherwise(F.regexp_extract_all("word", F.lit(RUN), F.lit(0)))
    runs = rows.select("*", F.posexplode(run).alias("number", "run"))
    value = F.regexp_extract("run", rf"{VALUE}$", 0)
    name = F.substr("run", F.lit(1), F.length("run") - F.length("value"))
    split = runs.withColumn("value", value).withColumn("name", name)
    keyed = F.col("value").rlike("[0-9]") & (F.length("value") >= 10)
    called = F.col("name").rlike(rf"(?i)(?:{names})")
    follows = (F.col("number") == 0) & (F.col("name") == "") & named_before(F.col("word"), F.col("before"), F.col("before2"))
    return split.where((F.col("value") != "") & (keyed | called | follows)).drop("run", "number")


def with_features(found: DataFrame) -> DataFrame:
    value, n = F.col("value"), F.length("value")
    pairs = F.greatest(n - 1, F.lit(1))

    def count(pattern: str, of: Column = value) -> Column:
        return F.regexp_count(of, F.lit(pattern))

    near = F.lower(F.concat_ws(" ", "before2", "before", "name", "value"))
    path = F.lower(F.coalesce("path", F.lit("")))
    columns = {
        "length": n,
        "switches": (count("(?<=[0-9])(?=[A-Za-z])") + count("(?<=[A-Za-z])(?=[0-9])")) / pairs,
        "case_switches": (count("(?<=[a-z])(?=[A-Z])") + count("(?<=[A-Z])(?=[a-z])")) / pairs,
        "digits": count("[0-9]") / n,
        "plain": 1 - F.length(F.regexp_replace(F.lower(value), any_of(PLAIN), "")) / n,
        "test_path": path.rlike(any_of(TEST_PATHS)),
        "depth": count("/", path),
        "secret_near": near.rlike(any_of(SECRET_NAMES)),
        "other_near": near.rlike(rf"(^|[^a-z])({any_of(OTHER_NAMES)})([^a-z]|$)"),
        "assigned": F.col("before").rlike("[=:]$") | (F.col("name") != ""),
        "quoted": F.col("word").rlike("^[^A-Za-z0-9]*[\"'`]|[=:][\"'`]"),
    }
    return found.withColumns({name: c.cast("double") for name, c in columns.items()})


def train(labelled: DataFrame, most: int = 20_000, seed: int = 7):
    """A forest from labelled findings: FEATURES and label (0 or 1; NULL is not labelled). At most
    `most` of them are used, those with the smallest hashes. None if not both labels are there."""
    order = F.xxhash64(F.lit(seed), *FEATURES, "label")
    sample = labelled.where("label IN (0, 1)").select(*FEATURES, F.col("label").cast("double").alias("label"))
    sample = cut(sample.orderBy(order, *FEATURES, "label").limit(most).coalesce(1))
    if sample.select("label").distinct().count() < 2:
        return None
    rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(sample)
    return RandomForestClassifier(numTrees=20, maxDepth=6, seed=seed).fit(rows)


def judge(found: DataFrame, forest, threshold: float = 0.5) -> DataFrame:
    """Adds score, the forest's share for a secret, and is_secret."""
    if forest is None:
        return found.withColumn("score", F.lit(0.5)).withColumn("is_secret", F.lit(True))
    rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(found)
    score = F.round(vector_to_array("probability")[1], 6)
    scored = forest.transform(rows).withColumn("score", score).withColumn("is_secret", F.col("score") >= threshold)
    return scored.drop("features", "rawPrediction", "probability", "prediction")


#: For labels where nobody has gone over findings: values that providers' formats or an assignment to
#: a secret's name give away are secrets; card numbers, phone numbers, addresses and words are not.
KNOWN_SECRET = r"^(AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abpr]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,}|[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64})$"


def label_by_format(found: DataFrame) -> DataFrame:
    named = F.lower(F.concat_ws(" ", "before2", "before", "name")).rlike(rf"({any_of(SECRET_NAMES)})[\"']?\s*[=:]")
    secret = F.col("value").rlike(KNOWN_SECRET) | (named & F.col("value").rlike("[0-9]") & F.col("value").rlike("[A-Za-z]"))
    return found.withColumn("label", secret.cast("int"))


def scan(documents: DataFrame, labelled: DataFrame, path: str = "source") -> DataFrame:
    """documents: doc_id, text and the path column. labelled: see `train`. Returns one row per
    candidate: doc_id, place, value, score, is_secret."""
    forest = train(labelled)
    return judge(with_features(candidates(documents, path)), forest).select("doc_id", "place", "value", "score", "is_secret")


def redact(documents: DataFrame, labelled: DataFrame, path: str = "source") -> DataFrame:
    """The documents with each secret's value masked in the text, and n_chars to match where the
    column is there. Documents without a secret pass as they are, without a shuffle of their text."""
    forest = train(labelled)
    key = F.xxhash64("doc_id", "text")
    keyed = documents.withColumn("scan_key", key)
    spans = judge(with_features(candidates(keyed.withColumn("doc_id", F.col("scan_key")), path)), forest).where("is_secret")
    # The longest value first; each only where it is a whole run.
    by_length = F.reverse(F.array_sort(F.collect_set(F.struct(F.length("value").alias("n"), "value"))))
    values = spans.groupBy(F.col("doc_id").alias("scan_found")).agg(by_length["value"].alias("scan_values"))
    joined = keyed.join(cut(values), F.col("scan_key") == F.col("scan_found"), "left")
    whole = [F.lit(r"(?<![A-Za-z0-9+_\-])\Q"), F.lit(r"\E(?![A-Za-z0-9+/_\-])")]
    text = F.aggregate("scan_values", F.col("text"), lambda t, v: F.regexp_replace(t, F.concat(whole[0], v, whole[1]), F.lit(MASK)))
    joined = joined.withColumn("text", F.when(F.col("scan_values").isNull(), F.col("text")).otherwise(text))
    if "n_chars" in documents.columns:
        joined = joined.withColumn("n_chars", F.when(F.col("scan_values").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast("long"))
    return joined.select(*documents.columns)
