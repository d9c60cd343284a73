r"""Secret scan: candidates from a pattern, false positives removed by a random forest.

A candidate is one of

* what follows a name with a credential word in it and an assignment sign
  (``password = "..."``), 8 characters or more: up to the closing quote on the same
  line, spaces included, or up to the next space, quote or closing mark.  The
  name, and the white space around the sign, line ends included, may be of any length;
* the password of ``user:password@`` in an address, whatever the user's length;
* a maximal run of at least ``MIN_LENGTH`` characters of ``[A-Za-z0-9_/+-]``, with up
  to two ``=`` after it, that no other Latin letter or digit touches.

The pattern goes forward: name, sign and opening quote are matched together with
the value and taken off again, so nothing bounds them.  The ``NEAR`` characters of the
text on each side of a candidate, other candidates included, are its neighbourhood,
in which long white space and long names before a value are shortened.  All of it
is SQL expressions: a text is split once at its candidates, and only candidates
with their neighbourhoods travel on.

Features of a candidate: its length; shares of character kinds and of transitions
between kinds; how it begins; how many different characters it has; how much of it dictionary
words cover; marks of the path (test or example, configuration, code) and of the
neighbouring words (credential words, an assignment just before, quotes, words
that name hashes, ids and numbers).  What depends on the candidate alone is worked out
once per distinct candidate and joined to its places; candidates with one place in
``HOT`` or more (``HOT`` of them at most) are broadcast, so none is a hot key.

The forest is trained by Spark's own trees on labelled findings (``candidate,
before, after, path, label``); ``max_findings`` bounds the rows used.

Defined cases: null text has no candidates, a null path is empty; repeated rows
are each scanned; a candidate may be of any length; without findings of both
labels every candidate counts as secret; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tumbleweed.llm.common import computed, cut, quoted

MIN_LENGTH = 16
ASSIGNED_LENGTH = 8
NAMES = r"(?i:token|secret|passw(?:or)?d|passwd|passphrase|pwd|api[_-]?key|access[_-]?key|credentials?|private[_-]?key)"
SIGN = r"(?:=>|:=|[=:])"
# a credential word with the rest of its name, then the sign
PLACE = NAMES + rf"[A-Za-z0-9_-]*+[\"'`]?\s*+{SIGN}\s*+"
# a value in quotes goes up to the closing quote; a bare one ends before closing marks
VALUE = (rf"(?:\"[^\"\n]{{{ASSIGNED_LENGTH},}}+(?=\")|'[^'\n]{{{ASSIGNED_LENGTH},}}+(?=')|`[^`\n]{{{ASSIGNED_LENGTH},}}+(?=`)"
         rf"|[\"'`]?(?![=:>])[^\s\"'`]{{{ASSIGNED_LENGTH - 1},}}[^\s\"'`,;.)\]}}>])")
NAMED = rf"(?<![A-Za-z0-9_-])[A-Za-z0-9_/+.-]*?{PLACE}"
ADDRESS = r"://[^\s/:@\"'`]*+:"
# a letter of another script may touch a run (text without spaces), a Latin one makes it part of a word
TOUCHES = r"A-Za-z0-9_/+\u00AA\u00BA\u00C0-\u024F\u1E00-\u1EFF-"
RUN = rf"(?<![{TOUCHES}])[A-Za-z0-9_/+-]{{{MIN_LENGTH},}}+={{0,2}}+(?![{TOUCHES}])"
FOUND = rf"(?:{ADDRESS}[^\s/@\"'`]++(?=@)|{NAMED}{VALUE}|{RUN})"
# what comes before the value in a match
LEAD = rf"^(?:{ADDRESS}|[A-Za-z0-9_/+.-]*?{PLACE}[\"'`]?(?=[^=:>]))"
NEAR = 48
#: Candidates with one place in so many are broadcast; there can be no more of them.
HOT = 1000
REDACTED = "[SECRET]"

CREDENTIAL = r"(?i)(token|secret|passw|passphrase|pwd|api.?key|access.?key|auth|credential|private|bearer|signature)"
NAMED_OTHERWISE = r"(?i)(sha|md5|hash|commit|checksum|digest|uuid|guid|version|order|invoice|card|example|sample|placeholder)"
# How keys of well-known services begin.
KNOWN_PREFIX = r"^(AKIA|ASIA|AIza|gh[pousr]_|github_pat_|glpat-|sk-|sk_live_|xox[abprs]-|eyJ)"
ASSIGNED = r"([=:]|=>)\s*[\"'`]?$"

#: Transitions counted between neighbouring characters, as pairs of character kinds.
KINDS = {"lower": "[a-z]", "upper": "[A-Z]", "digit": "[0-9]", "mark": "[_/+=-]"}
VOWEL, CONSONANT = "[aeiouAEIOU]", "[b-df-hj-np-tv-zB-DF-HJ-NP-TV-Z]"


def candidates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str = "source") -> DataFrame:
    """``(doc_id, text_hash, path, start, candidate, before, after)`` of every candidate; ``start`` counts code points from 0."""
    t = quoted(text).cast("string")
    src = quoted(path).cast("string") if path in docs.columns else F.lit("")
    found = (docs.where(t.rlike(FOUND))
             .select(quoted(doc_id).alias("doc_id"), F.xxhash64(t).alias("text_hash"), F.coalesce(src, F.lit("")).alias("path"),
                     computed(F.regexp_extract_all(t, F.lit(FOUND), F.lit(0))).alias("whole"), F.split(t, FOUND, -1).alias("gap")))
    found = found.withColumn("c", computed(F.transform("whole", lambda w: F.regexp_replace(w, LEAD, ""))))
    found = found.withColumn("lead", F.zip_with("whole", "c", lambda w, c: F.left(w, F.length(w) - F.length(c))))
    # where each candidate starts: lengths of the gaps and candidates before it, added up
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts"))
    lengths = F.transform("c", lambda c, i: F.struct(F.length(c).alias("c"), (F.length(F.get("gap", i)) + F.length(F.get("lead", i))).alias("g")))
    starts = F.aggregate(lengths, zero, lambda acc, x: F.struct(
        (acc["at"] + x["g"] + x["c"]).alias("at"), F.concat(acc["starts"], F.array(acc["at"] + x["g"])).alias("starts")), lambda acc: acc["starts"])
    found = found.withColumn("starts", starts)
    # for the neighbourhood: white space before a value as one space, and of a name too long for it the credential word and the sign
    short = lambda x: F.when(F.length(x) <= NEAR, x).otherwise(F.regexp_replace(
        F.regexp_replace(x, r"\s+", " "), rf"^[A-Za-z0-9_/+.-]*?({NAMES})[A-Za-z0-9_-]*+([\"'`]?\s*{SIGN}\s*[\"'`]?)$", "$1$2"))
    found = found.withColumn("gap", computed(F.transform("gap", lambda g, i: F.concat(g, short(F.coalesce(F.get("lead", i), F.lit("")))))))
    # a gap and its candidate are four characters or more: so many of them hold the neighbourhood
    n = NEAR // 4
    tails = F.transform("c", lambda c, i: F.right(F.concat(F.get("gap", i), c), F.lit(NEAR)))
    heads = F.transform("c", lambda c, i: F.left(F.concat(c, F.get("gap", i + 1)), F.lit(NEAR)))
    rows = F.transform("c", lambda c, i: F.struct(
        c.alias("candidate"), F.get("starts", i).alias("start"),
        F.right(F.concat(F.array_join(F.slice("tails", F.greatest(i + 1 - n, F.lit(1)), F.least(i, F.lit(n))), ""), F.get("gap", i)), F.lit(NEAR)).alias("before"),
        F.left(F.concat(F.get("gap", i + 1), F.array_join(F.slice("heads", i + 2, F.lit(n)), "")), F.lit(NEAR)).alias("after")))
    return (found.withColumn("tails", tails).withColumn("heads", heads).withColumn("row", F.explode(rows))
            .select("doc_id", "text_hash", "path", "row.start", "row.candidate", "row.before", "row.after"))


def dictionary(docs: DataFrame, text: str = "text", size: int = 5000) -> DataFrame:
    """The ``size`` most frequent lower-case words of four letters and more, over all rows."""
    words = docs.select(F.explode(F.regexp_extract_all(F.lower(quoted(text).cast("string")), F.lit(r"(?<![\p{L}\p{N}])[a-z]{4,24}(?![\p{L}\p{N}])"), F.lit(0))).alias("word"))
    return words.groupBy("word").count().orderBy(F.desc("count"), "word").limit(size).select("word")


def _count(c: Column, pattern: str) -> Column:
    return F.regexp_count(c, F.lit(pattern))


def features(found: DataFrame, words: DataFrame) -> tuple[DataFrame, list[str]]:
    """``found`` with feature columns, and their names.

    What depends on the candidate alone is computed once per distinct candidate.
    ``words`` is a dictionary of bounded size; ``found`` is read more than once.
    """
    c = F.col("candidate")
    n = F.length(c)
    distinct = found.groupBy("candidate").agg(F.count("*").alias("places"))
    runs = (distinct.select("candidate", F.explode(F.regexp_extract_all(F.lower(c), F.lit("[a-z]{4,}"), F.lit(0))).alias("word"))
            .join(words, "word").groupBy("candidate").agg(F.sum(F.length("word")).alias("covered")))
    own = {
        "f_length": n,
        "f_distinct": F.size(F.array_distinct(F.split(c, ""))) / n,
        "f_hex": c.rlike("^([0-9a-f]+|[0-9A-F]+)$").cast("int"),
        "f_digits_only": c.rlike("^[0-9]+$").cast("int"),
        "f_letters_only": c.rlike("^[A-Za-z]+$").cast("int"),
        "f_uuid": c.rlike("(?i)^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$").cast("int"),
        "f_known_prefix": c.rlike(KNOWN_PREFIX).cast("int"),
        "f_longest_run": F.array_max(F.transform(F.regexp_extract_all(c, F.lit(r"([a-z]+|[A-Z]+|[0-9]+|[^A-Za-z0-9]+)"), F.lit(1)), F.length)) / n,
        "f_vowel_turns": (_count(c, f"(?={VOWEL}{CONSONANT})") + _count(c, f"(?={CONSONANT}{VOWEL})")) / n,
        "f_repeats": _count(c, r"(?=(.)\1)") / n,
        "f_covered": F.coalesce(F.col("covered"), F.lit(0)) / n,
    }
    own["f_other"] = _count(c, "[^A-Za-z0-9_/+=-]") / n
    own["f_code"] = c.rlike(r"[(){}<>$\[\]]|\*{4}").cast("int")
    own |= {f"f_{k}": _count(c, p) / n for k, p in KINDS.items()}
    own |= {f"f_{a}_{b}": _count(c, f"(?={p}{q})") / n for a, p in KINDS.items() for b, q in KINDS.items() if a != b and "mark" not in (a, b)}
    per_candidate = cut(distinct.join(runs, "candidate", "left").select("candidate", "places", *[v.cast("double").alias(k) for k, v in own.items()]))
    around = {
        "f_credential": F.col("before").rlike(CREDENTIAL),
        "f_placed": F.col("before").rlike(PLACE + "[\"'`]?$"),
        "f_assigned": F.col("before").rlike(ASSIGNED),
        "f_quoted": F.col("before").rlike("[\"'`]$") & F.col("after").rlike("^[\"'`]"),
        "f_named_otherwise": F.col("before").rlike(NAMED_OTHERWISE) | c.rlike(NAMED_OTHERWISE),
        "f_in_address": F.col("before").rlike(r"[./:@]$"),
        "f_address_password": F.col("before").rlike(r"://[^\s/:@]*:$") & F.col("after").rlike("^@"),
        "f_path_test": F.col("path").rlike("(?i)(test|example|sample|fixture|mock|doc)"),
        "f_path_config": F.col("path").rlike(r"(?i)(\.(env|ya?ml|json|ini|cfg|conf|toml|properties)$|config|settings)"),
        "f_path_code": F.col("path").rlike(r"(?i)\.(py|js|ts|java|go|rb|c|cc|cpp|rs|php|sh)$"),
    }
    least = max(2, -(-(per_candidate.agg(F.sum("places")).first()[0] or 0) // HOT))
    hot = F.broadcast(per_candidate.where(F.col("places") >= least).drop("places"))
    cold = per_candidate.where(F.col("places") < least).drop("places")
    joined = found.join(hot, "candidate").unionByName(found.join(hot.select("candidate"), "candidate", "left_anti").join(cold, "candidate"))
    return joined.select("*", *[v.cast("double").alias(k) for k, v in around.items()]), [*own, *around]


class Forest:
    """A trained forest with the dictionary its features use."""

    def __init__(self, findings: DataFrame, words: DataFrame, max_findings: int = 20000, trees: int = 24, depth: int = 8):
        self.words = words
        bounded = (findings.select("candidate", "before", "after", "path", F.col("label").cast("double").alias("label"))
                   .orderBy(F.xxhash64("candidate", "before", "after", "path"), "label").limit(max_findings))
        rows, self.names = features(cut(bounded), words)
        rows = cut(self._assembled(rows).select("features", "label").coalesce(4))
        self.model = None
        if rows.select("label").distinct().count() == 2:
            self.model = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=17, cacheNodeIds=False).fit(rows)

    def _assembled(self, rows: DataFrame) -> DataFrame:
        return VectorAssembler(inputCols=self.names, outputCol="features").transform(rows)

    def judge(self, found: DataFrame) -> DataFrame:
        """``found`` with ``probability`` and ``is_secret``."""
        rows, _ = features(found, self.words)
        if self.model is None:
            return found.withColumn("probability", F.lit(1.0)).withColumn("is_secret", F.lit(True))
        done = self.model.transform(self._assembled(rows))
        return (done.withColumn("share", F.round(vector_to_array("probability")[1], 6))
                .select(*found.columns, F.col("share").alias("probability"), (F.col("share") >= 0.5).alias("is_secret")))


def trained(docs: DataFrame, findings: DataFrame, text: str = "text") -> Forest:
    """A forest for ``docs``, whose frequent words are its dictionary."""
    return Forest(findings, cut(dictionary(docs, text)))


def scan(docs: DataFrame, forest: Forest, doc_id: str = "doc_id", text: str = "text", path: str = "source") -> DataFrame:
    """Every candidate of every row, judged."""
    return forest.judge(cut(candidates(docs, doc_id, text, path)))


def redact(docs: DataFrame, forest: Forest, doc_id: str = "doc_id", text: str = "text", path: str = "source",
           size: str = "n_chars") -> DataFrame:
    """``docs`` with every secret replaced by ``REDACTED``; ``size``, if present, is counted anew for changed texts.

    Secrets are gathered per distinct text, so what a group holds is bounded by that text.
    """
    place = F.struct("start", F.length("candidate").alias("n"))
    hits = (scan(docs, forest, doc_id, text, path).where("is_secret")
            .groupBy(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"))
            .agg(F.array_sort(F.collect_set("candidate"), lambda a, b: F.length(b) - F.length(a)).alias("__secrets"), F.array_sort(F.collect_set(place)).alias("__places")))
    joined = docs.withColumn("__own_hash", F.xxhash64(quoted(text).cast("string"))).join(
        hits, quoted(doc_id).eqNullSafe(F.col("__id")) & (F.col("__own_hash") == F.col("__hash")), "left")
    # every secret in its place; a long one also wherever else it stands (a short one may be part of a word)
    t = quoted(text)
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    replaced = F.aggregate("__places", zero, lambda acc, x: F.struct(
        (x["start"] + x["n"]).alias("at"), F.concat(acc["out"], F.substring(t, acc["at"] + 1, x["start"] - acc["at"]), F.lit(REDACTED)).alias("out")),
        lambda acc: F.concat(acc["out"], F.substring(t, acc["at"] + 1, F.length(t))))
    long = F.filter("__secrets", lambda x: F.length(x) >= MIN_LENGTH)
    clean = F.when(F.col("__secrets").isNotNull(), F.aggregate(long, replaced, lambda acc, x: F.replace(acc, x, F.lit(REDACTED)))).otherwise(t)
    joined = joined.withColumn("__clean", computed(clean))
    clean = F.col("__clean")
    columns = [clean.alias(c) if c == text else F.when(F.col("__secrets").isNotNull(), F.length(clean).cast(dict(docs.dtypes)[c])).otherwise(quoted(c)).alias(c)
               if c == size else quoted(c) for c in docs.columns]
    return joined.select(*columns)
