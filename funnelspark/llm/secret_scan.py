"""Secret scan with a random forest that removes false positives, all in
DataFrame functions (no Python worker runs).

Candidates are values assigned to a credential name (any length and character; the
name ends at the credential word or at a known suffix such as ``_key`` or
``_production``), values after ``Bearer``, web tokens, and maximal runs of 16 or more
key characters.  Each one is described by its length, character classes and
transitions, how much of it words of the corpus dictionary cover, the path it
stands in and its neighbouring words.  Keys of known kinds show by themselves; all
other candidates are judged by a random forest trained from labelled findings.  The
forest's trees are applied as column expressions inside each document's row, so
nothing is exploded, shuffled or joined when scanning.

Labelled findings come as a DataFrame; ``confident_findings`` gives those of the
corpus that need no judgement: values with digits assigned to a credential name,
quoted or not, and keys of known kinds (1); numbers, dates, times, addresses, paths and
versions after any name, words without a digit, parts of addresses, hashes, uuids and
numbers without such a name, and words of prose and variables after one (0).  At most
``MAX_FINDINGS`` rows of each kind train the forest, with ``SEEDS`` findings made from
the templates below, so that it knows both kinds whatever the corpus holds.

Defined cases: a null text has no candidates and stays null when redacted; a
null path counts as empty; a document row gives one row whatever its id, so
repeated documents and null ids are kept; without a forest (``scan`` with ``None``) only keys
of known kinds are reported; ``scan`` replaces columns of its result's names, ``redact``
keeps every column whatever its name.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from funnelspark.llm.common import columns_of, materialize

#: A credential name and what stands between it and its value, but for a quote.
_SUFFIX = (r"(?i:[_-]?(?:key|token|secret|password|pass|value|string|prod|production|staging|dev|development"
           r"|test|live|main|old|new|default|[0-9]{1,3}))?")
ASSIGNMENT = (r"(?i:token|secrets?|passw(?:or)?ds?|passphrase|pwd|api.?keys?|access.?keys?|auth|credentials?"
              rf"|private.?key){_SUFFIX}{_SUFFIX}" r"[\"'`]?\s{0,3}(?::=|=>|={1,3}|:)\s{0,3}")
BEARER = r"(?i:bearer)\s{1,3}"
#: Assigned values of any length and character (to the closing quote, or else to the next space
#: or quote), values after Bearer, web tokens of three parts, and runs of 16 or more key characters.
CANDIDATE = (
    r"(?<=[=:>\s\"'`])(?<=[=:>]\s{0,3}[\"'`]?)(?:"
    + "".join(rf"(?<={ASSIGNMENT}{q})[^{q}\r\n]+(?={q})|" for q in "\"'`")
    + rf"(?<={ASSIGNMENT}[\"'`]?)(?![=:]|(?i:bearer|basic)\s)[^\s\"'`]*[^\s\"'`.,;:)\]}}>])"
    rf"|(?<=\s)(?<={BEARER})[^\s\"'`]*[^\s\"'`.,;:)\]}}>]"
    r"|(?<![A-Za-z0-9+/_-])(?:eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]*"
    r"|[A-Za-z0-9+/_-]{16,}={0,2})")
#: Kinds of keys that show by themselves.
KEY_KINDS = (r"^(?:A[KS]IA[0-9A-Z]{16}$|gh[pousr]_[A-Za-z0-9]{20}|github_pat_[A-Za-z0-9_]{20}|glpat-[A-Za-z0-9_-]{20}"
             r"|xox[abprs]-[0-9A-Za-z-]{10}|[sr]k_(?:live|test)_[A-Za-z0-9]{16}|sk-(?=.*[0-9].*[0-9])[A-Za-z0-9_-]{20}"
             r"|AIza[A-Za-z0-9_-]{30}|(?:npm|hf)_[A-Za-z0-9]{30}|eyJ[A-Za-z0-9_-]+\.eyJ)")
#: Values that stand for another: variables, calls, blanks.
REFERENCE = r"^(?:\$[{(]|\$[A-Za-z_]+$|\{\{|%\(|<[^>]*>?$|[xX*.]+$|(?i:null|none|nil|true|false|undefined)$)"
CALL = r"^[A-Za-z_][A-Za-z0-9_.]*(?:[(\[]|\.[A-Za-z_])"
HASH_UUID_NUMBER = (r"^(?:(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{56}|[0-9a-f]{64}|[0-9a-f]{96}|[0-9a-f]{128})"
                    r"|(?:[0-9A-F]{32}|[0-9A-F]{40}|[0-9A-F]{64})"
                    r"|[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}|[0-9+/_-]+)$")
#: Values that are no secrets after any name: numbers (with a unit), dates and times, addresses
#: without a password, paths, versions, mail addresses.
PLAIN_VALUE = (r"^(?:[+-]?[0-9][0-9_,.]*(?:[eE][+-]?[0-9]+)?[A-Za-z%]{0,3}"
               r"|[0-9]{4}[-/.][0-9]{1,2}(?:[-/.][0-9]{1,2})?(?:[T_ ][0-9:.]+(?:Z|[+-][0-9:]+)?)?"
               r"|[0-9]{1,2}[:/.][0-9]{1,2}(?:[:/.][0-9.]{1,7})?Z?"
               r"|(?:https?|ftp|file|s3|gs|hdfs|git|ssh)://[^\s:@]*(?::[0-9]+)?(?:[/?#][^\s@]*)?"
               r"|(?:~|\.{1,2}|[A-Za-z]:)?/[A-Za-z0-9_.@-]+(?:/[A-Za-z0-9_.@-]+)*/?"
               r"|v[0-9]+(?:\.[0-9]+)+[A-Za-z0-9.+-]{0,12}|[A-Za-z0-9_.+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+)$")
#: Characters of context that the neighbouring words are taken from.
LEFT_CONTEXT, RIGHT_CONTEXT = 48, 16
CREDENTIAL_NAMES = r"(?i)(token|secret|passw|pwd|api.?key|access.?key|auth|credential|private.?key|bearer)"
PATH_SECRET = r"(?i)(\.env|\.pem|conf|cred|secret|key|deploy)"
PATH_EXAMPLE = r"(?i)(test|example|sample|fixture|mock|docs?/)"
DICTIONARY_WORDS = 200
MAX_FINDINGS = 4000
TREES, DEPTH = 20, 6
#: Made findings of each kind.
SEEDS = 400
#: Texts of made findings: %h and %m stand for hexadecimal and mixed characters, %p for a short
#: word with digits and a sign, %w for letters, %n for digits, %d for a date.
SEED_SECRETS = ('password = "%p"', "DB_PASSWORD='%p'", "pwd=%p ", 'api_key: "%m"', "API_KEY=%h", "secret: %m",
                'token = "%h"', "Authorization: Bearer %m end", "access_key = %m", 'secret = "%w-%w#%w"',
                'api_key = "%m"', "password: %h, ok", "PRIVATE_KEY_PRODUCTION=%m", 'credentials = "%w%n!"')
SEED_OTHERS = ("token: %n", "password = %n", 'token = "%d"', "secret: %dT10:20:30", "auth = https://example.org/%w/%n",
               "api_key: /etc/%w/%w-%n", "token=%n%n", "auth: v%n.%n.1", "password: %w", "token = %w.%w(", "secret = ${%w}",
               "commit: %h", "id = %w-%n-%w-%n-%w", "url = %w%w%w%w", "name: %n%n%n", 'password = "<%w>"',
               "auth = %w@example.org", "access_key: ./%w/%w/%n")
ACCEPT_VOTES = 0.5
PLACEHOLDER = "[secret]"

FEATURES = ("n", "digits", "upper", "hexadecimal", "vowels", "distinct", "kind_changes",
            "case_changes", "consonant_runs", "covered", "named", "assigned", "quoted",
            "address", "left_word", "path_secret", "path_example", "credential", "key_kind",
            "reference", "symbols", "spaces", "spaced", "plain")


def dictionary(docs: DataFrame, text_col: str = "text", size: int = DICTIONARY_WORDS) -> list[str]:
    """The most frequent words of 2 to 8 letters a-z of all texts (``size`` at most)."""
    words = docs.select(F.explode(F.split(F.lower(F.col(text_col)), "[^a-z]+")).alias("w")) \
        .where(F.length("w").between(2, 8)).groupBy("w").count()
    return [r.w for r in words.orderBy(F.desc("count"), "w").limit(size).collect()]


def _share(c: Column, pattern: str) -> Column:
    return F.regexp_count(c, F.lit(pattern)) / F.length(c)


def _flag(condition: Column) -> Column:
    return condition.cast("double")


def describe(c: Column, left: Column, right: Column, path: Column, words: list[str]) -> Column:
    """Struct of the features of a candidate ``c`` between ``left`` and ``right``."""
    n = F.length(c).cast("double")
    by_length = sorted(words, key=lambda w: (-len(w), w))
    covered = (n - F.length(F.regexp_replace(F.lower(c), "|".join(by_length), ""))) / n \
        if by_length else F.lit(0.0)
    quoted = F.regexp_like(left, F.lit(r"[\"'`]$")) & F.regexp_like(right, F.lit(r"^[\"'`]"))
    values = {
        "n": F.least(n, F.lit(128.0)),
        "digits": _share(c, "[0-9]"), "upper": _share(c, "[A-Z]"),
        "hexadecimal": _flag(F.regexp_like(c, F.lit("^[0-9a-fA-F]+$"))),
        "vowels": _share(c, "[aeiouAEIOU]"),
        "distinct": F.size(F.array_distinct(F.split(c, ""))) / n,
        "kind_changes": _share(c, "[A-Za-z](?=[0-9])|[0-9](?=[A-Za-z])"),
        "case_changes": _share(c, "[a-z](?=[A-Z])"),
        "consonant_runs": _share(c, "[bcdfghjklmnpqrstvwxzBCDFGHJKLMNPQRSTVWXZ]{4}"),
        "covered": covered,
        "named": _flag(F.regexp_like(left, F.lit(CREDENTIAL_NAMES))),
        "assigned": _flag(F.regexp_like(left, F.lit(r"[=:]\s*[\"'`]?$"))),
        "quoted": _flag(quoted),
        "address": _flag(F.regexp_like(left, F.lit(r"(https?://|www\.|@)\S*$"))
                         | F.regexp_like(right, F.lit(r"^(@|\.[a-z]{2,})"))),
        "left_word": F.length(F.regexp_extract(left, r"([A-Za-z]*)[^A-Za-z]*$", 1)).cast("double"),
        "path_secret": _flag(F.regexp_like(path, F.lit(PATH_SECRET))),
        "path_example": _flag(F.regexp_like(path, F.lit(PATH_EXAMPLE))),
        "credential": _flag(F.regexp_like(left, F.lit(rf"(?:{ASSIGNMENT}[\"'`]?|{BEARER})$"))),
        "key_kind": _flag(F.regexp_like(c, F.lit(KEY_KINDS))),
        "reference": _flag(F.regexp_like(c, F.lit(REFERENCE)) | (~quoted & F.regexp_like(c, F.lit(CALL)))),
        "symbols": _share(c, r"[^A-Za-z0-9\s]"),
        "spaces": _share(c, r"\s"),
        "spaced": _flag(F.regexp_like(left, F.lit(r"\s$"))),
        "plain": _flag(F.regexp_like(c, F.lit(PLAIN_VALUE))),
    }
    return F.struct(*[values[name].alias(name) for name in FEATURES])


def _pieces(docs: DataFrame, text_col: str) -> DataFrame:
    """``_found`` (the candidates) and ``_between`` (one more: the text around them)."""
    return docs.withColumn("_found", F.regexp_extract_all(F.col(text_col), F.lit(CANDIDATE), 0)) \
        .withColumn("_between", F.when(F.size("_found") > 0, F.split(F.col(text_col), CANDIDATE, -1)))


def _described(path: Column, words: list[str]) -> Column:
    """Array of feature structs, in the order of the candidates."""
    # a long name before a value is a candidate itself
    left = lambda i: F.right(F.concat(F.coalesce(F.get("_found", i - 1), F.lit("")),
                                      F.get("_between", i)), F.lit(LEFT_CONTEXT))
    right = lambda i: F.left(F.get("_between", i + 1), F.lit(RIGHT_CONTEXT))
    return F.transform("_found", lambda c, i: describe(c, left(i), right(i), path, words))


def _path(docs: DataFrame, path_col: str | None) -> Column:
    return F.coalesce(F.col(path_col).cast("string"), F.lit("")) if path_col else F.lit("")


def findings(docs: DataFrame, words: list[str], text_col: str = "text",
             path_col: str | None = "source") -> DataFrame:
    """One row for each candidate: ``secret`` and its features."""
    rows = _pieces(docs, text_col).where(F.size("_found") > 0)
    return rows.select(F.explode(F.arrays_zip(
        F.col("_found").alias("c"), _described(_path(docs, path_col), words).alias("f"))).alias("x")) \
        .select(F.col("x.c").alias("secret"), "x.f.*")


def confident_findings(found: DataFrame) -> DataFrame:
    """The findings that need no judgement, with ``label``."""
    f = F.col
    value = (f("reference") == 0) & (f("spaces") == 0)
    secret = (f("path_example") == 0) & (
        (value & (f("named") > 0) & (f("assigned") > 0) & (f("quoted") > 0) & (f("digits") > 0.05))
        | (value & (f("credential") > 0) & (f("digits") > 0.05) & (f("n") >= 8)))
    unnamed = f("named") == 0
    prose = (f("credential") > 0) & (f("quoted") == 0) & (
        (f("reference") > 0) | ((f("spaced") > 0) & F.regexp_like("secret", F.lit("^[A-Za-z]+$"))))
    sure = F.when(_known_kind(f), 1.0).when(f("plain") > 0, 0.0).when(secret, 1.0) \
        .when(unnamed & (f("key_kind") == 0) & ((f("digits") == 0) | (f("address") > 0) | F.regexp_like(
            "secret", F.lit(HASH_UUID_NUMBER))), 0.0).when(prose, 0.0)
    return found.withColumn("label", sure).where("label is not null")


def _known_kind(f) -> Column:
    """Whether a candidate with features ``f(name)`` is a key that shows by itself."""
    return (f("path_example") == 0) & (f("key_kind") > 0)


def seed_findings(spark, words: list[str], count: int = SEEDS) -> DataFrame:
    """Made findings of both kinds, with ``label``."""
    spread = lambda salt: F.sha2(F.concat_ws("-", "id", F.lit(salt)), 512)
    mixed = F.translate(F.base64(F.unhex(spread("m"))), "+/=", "xyz")
    letters = lambda salt, n: F.substring(F.translate(spread(salt), "0123456789", "ghijklmnop"), 1, n)
    digits = lambda n: F.substring(F.regexp_replace(spread("n"), "[a-f]", ""), 1, n)
    size = lambda low, high: (F.lit(low) + F.col("id") * 7 % (high - low)).cast("int")
    fills = {"%h": F.substring(spread("h"), F.lit(1), F.when(F.col("id") % 2 == 0, 40).otherwise(32)),
             "%m": F.substring(mixed, F.lit(1), size(16, 44)),
             "%p": F.concat(F.initcap(letters("p", 5)), F.substring(digits(9), F.lit(1), size(1, 4)),
                            F.element_at(F.split(F.lit("! # $ & @ -"), " "), (F.col("id") % 6 + 1).cast("int")),
                            letters("q", 2)),
             "%w": letters("w", 6), "%n": F.substring(digits(12), F.lit(1), size(1, 12)),
             "%d": F.date_add(F.lit("2001-01-01").cast("date"), (F.col("id") * 37).cast("int")).cast("string")}
    kinds = []
    for label, templates in ((1.0, SEED_SECRETS), (0.0, SEED_OTHERS)):
        text = F.element_at(F.array(*[F.lit(t) for t in templates]), (F.col("id") % len(templates) + 1).cast("int"))
        for mark, fill in fills.items():
            text = F.replace(text, F.lit(mark), fill)
        made = spark.range(count).select(text.alias("text"), F.lit("src").alias("source"))
        kinds.append(findings(made, words).withColumn("label", F.lit(label)))
    return kinds[0].unionByName(kinds[1])


def bounded(labelled: DataFrame, most: int = MAX_FINDINGS) -> DataFrame:
    """About ``most`` rows of each label at most, chosen by a hash of the candidate."""
    counts = {r.label: r["count"] for r in labelled.groupBy("label").count().collect()}
    share = reduce(lambda e, kv: e.when(F.col("label") == kv[0], min(1.0, most / kv[1])),
                   counts.items(), F.when(F.lit(False), 0.0))
    return labelled.where(F.pmod(F.xxhash64("secret", "left_word"), F.lit(1_000_000))
                          < share * 1_000_000)


def train(labelled: DataFrame, trees: int = TREES, depth: int = DEPTH, seed: int = 5) -> list | None:
    """The trees of a random forest as nested (feature, threshold, left, right), leaves as
    numbers; None if there are not findings of both kinds."""
    rows = materialize(bounded(labelled).select("label", *FEATURES), "secret-sample")
    if rows.select("label").distinct().count() < 2:
        return None
    return [read_tree(t.toDebugString) for t in fit(rows, trees, depth, seed).trees]


def fit(rows: DataFrame, trees: int = TREES, depth: int = DEPTH, seed: int = 5):
    """MLlib's forest of rows (label and features)."""
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features", handleInvalid="skip")
    return RandomForestClassifier(labelCol="label", numTrees=trees, maxDepth=depth, seed=seed,
                                  featureSubsetStrategy="onethird").fit(vectors.transform(rows))


def read_tree(described: str):
    """The tree that a fitted model's ``toDebugString`` describes."""
    lines = iter([x.strip() for x in described.splitlines() if x.strip()][1:])

    def node():
        line = next(lines)
        if line.startswith("Predict:"):
            return float(line.split(":")[1])
        feature, threshold = line.split("feature ")[1].rstrip(")").split(" <= ")
        left = node()
        next(lines)  # Else
        return int(feature), float(threshold), left, node()
    return node()


def _vote(tree, f: Column) -> Column:
    if not isinstance(tree, tuple):
        return F.lit(tree)
    feature, threshold, left, right = tree
    return F.when(f[FEATURES[feature]] <= threshold, _vote(left, f)).otherwise(_vote(right, f))


def votes(forest: list, f: Column) -> Column:
    """Share of the trees that take a candidate for a secret."""
    return reduce(lambda a, b: a + b, [_vote(t, f) for t in forest]) / len(forest)


def scan(docs: DataFrame, words: list[str], forest: list | None, text_col: str = "text",
         path_col: str | None = "source") -> DataFrame:
    """``docs`` plus ``n_candidates``, ``findings`` (start, end in characters, votes)
    and ``redacted`` (the text with each secret replaced)."""
    new = ("n_candidates", "findings", "redacted")
    rows = _pieces(docs.drop(*new), text_col)
    scored = F.transform(
        _described(_path(docs, path_col), words),
        lambda f: F.when(_known_kind(f.getField), 1.0).otherwise(votes(forest, f) if forest else 0.0))
    rows = rows.withColumn("_votes", F.when(F.size("_found") > 0, scored))
    step = F.arrays_zip(F.col("_found").alias("c"), F.col("_between").alias("b"),
                        F.col("_votes").alias("v"))

    def walk(acc, x):
        start = acc["at"] + F.length(x["b"])
        end = start + F.coalesce(F.length(x["c"]), F.lit(0))
        hit = F.coalesce(x["v"], F.lit(0.0)) >= ACCEPT_VOTES
        span = F.array(F.struct(start.alias("start"), end.alias("end"), x["v"].alias("votes")))
        return F.struct(end.alias("at"), F.when(hit, F.concat(acc["spans"], span))
                        .otherwise(acc["spans"]).alias("spans"))
    none = F.array().cast("array<struct<start:int,end:int,votes:double>>")
    spans = F.aggregate(step, F.struct(F.lit(0).alias("at"), none.alias("spans")), walk,
                        lambda acc: acc["spans"])
    redacted = F.array_join(F.transform(step, lambda x: F.concat(
        x["b"], F.when(F.coalesce(x["v"], F.lit(0.0)) >= ACCEPT_VOTES, PLACEHOLDER)
        .otherwise(F.coalesce(x["c"], F.lit(""))))), "")
    some = F.size("_found") > 0
    return rows.select(
        *columns_of(docs.drop(*new)),
        F.greatest(F.size("_found"), F.lit(0)).cast("long").alias("n_candidates"),
        F.when(some, spans).otherwise(none).alias("findings"),
        F.when(some & F.exists("_votes", lambda v: v >= ACCEPT_VOTES), redacted)
        .otherwise(F.col(text_col)).alias("redacted"))


def learn(docs: DataFrame, text_col: str = "text", path_col: str | None = "source",
          labelled: DataFrame | None = None) -> tuple[list[str], list | None]:
    """(dictionary words, forest) for ``scan``; without ``labelled`` findings the
    confident ones of ``docs`` and made ones are used."""
    words = dictionary(docs, text_col)
    if labelled is None:
        columns = ["secret", "label", *FEATURES]
        own = confident_findings(findings(docs, words, text_col, path_col)).select(columns)
        labelled = materialize(own, "secret-findings").unionByName(   # one pass over the texts
            seed_findings(docs.sparkSession, words).select(columns))
    return words, train(labelled)


def secret_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  path_col: str | None = "source") -> DataFrame:
    """One row per document row: doc_id, n_candidates, n_secrets, spans, redacted_sha256."""
    words, forest = learn(docs, text_col, path_col)
    kept = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                       (F.col(path_col) if path_col else F.lit("")).alias("source"))
    return scan(kept, words, forest).select(
        "doc_id", "n_candidates", F.size("findings").cast("long").alias("n_secrets"),
        F.transform("findings", lambda x: F.struct(x["start"], x["end"])).alias("spans"),
        F.sha2(F.coalesce("redacted", F.lit("")), 256).alias("redacted_sha256"))


def redact(docs: DataFrame, text_col: str = "text", path_col: str | None = "source",
           length_col: str | None = None) -> DataFrame:
    """``docs`` with every secret in the text replaced, and ``length_col`` (if given) set to
    the length of a text that changed; other columns as they were."""
    words, forest = learn(docs, text_col, path_col)
    row = F.struct(*columns_of(docs)).alias("_row")
    out = scan(docs.select(row, F.col(text_col).alias("text"),
                           _path(docs, path_col).alias("source")), words, forest)

    def column(name):
        old = F.col("_row").getField(name)
        if name == text_col:
            return F.col("redacted").alias(name)
        if name == length_col:
            return F.when(F.size("findings") > 0, F.length("redacted").cast(
                docs.schema[name].dataType)).otherwise(old).alias(name)
        return old.alias(name)
    return out.select(*[column(c) for c in docs.columns])
