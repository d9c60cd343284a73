"""Stand-in inputs: rows of the given tables brought into the schema an operator expects."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tumbleweed.llm.common import cut
from tumbleweed.llm.secrets import candidates


def chat_records(conversations: DataFrame) -> DataFrame:
    """One JSON record per conversation, in one of four layouts.

    Rows are ordered by turn (then role and text).  A user row and an assistant
    row become prompt and completion; system, user, assistant become
    instruction, input, output; other conversations become message lists, of two
    kinds by the parity of their length.
    """
    row = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("content"))
    convs = (conversations.groupBy("conv_id").agg(F.array_sort(F.collect_list(row)).alias("t"))
             .withColumn("roles", F.array_join(F.col("t.role"), ",")))
    text = lambda i: F.element_at("t", i)["content"]
    named = F.create_map(F.lit("user"), F.lit("human"), F.lit("assistant"), F.lit("gpt"))
    shared = F.to_json(F.struct(F.transform("t", lambda m: F.struct(
        F.coalesce(named[m["role"]], m["role"]).alias("from"), m["content"].alias("value"))).alias("conversations")))
    plain = F.to_json(F.struct(F.transform("t", lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"))).alias("messages")))
    record = (F.when(F.col("roles") == "user,assistant", F.to_json(F.struct(text(1).alias("prompt"), text(2).alias("completion"))))
              .when(F.col("roles") == "system,user,assistant",
                    F.to_json(F.struct(text(1).alias("instruction"), text(2).alias("input"), text(3).alias("output"))))
              .when((F.size("t") % 2 == 1) & F.forall("t", lambda m: m["role"].isin("system", "user", "assistant")), shared)
              .otherwise(plain))
    return convs.select("conv_id", record.alias("record"))


def labelled_findings(documents: DataFrame, per_kind: int = 400) -> DataFrame:
    """Labelled findings ``(candidate, before, after, path, label)`` for training.

    No given table holds labelled findings.  Contexts are words of the first
    ``per_kind`` documents in the order of hashed ids; values are digests of those
    ids in the formats named below.  Label 1: values in a credential's place, and
    keys of well-known formats anywhere.
    Label 0: the same kinds of values in other places (commits, checksums, ids,
    card numbers, paths), words, identifiers and placeholders.
    """
    usable = documents.where("doc_id is not null and text is not null")
    chosen = usable.select("doc_id").distinct().orderBy(F.xxhash64("doc_id", F.lit("findings")), "doc_id").limit(per_kind)
    # per_kind ids at most: texts stay where they are but for these
    base = (usable.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"))
            .select("doc_id", F.split("text", r"\s+").alias("w")))
    # (text before, kind of value, text after, label)
    positive = [(name + sign, kind, sign[-1] if sign[-1] in "\"'" else "", 1)
                for name, sign in (("token", ' = "'), ("TOKEN", ' = "'), ("api_key", ": "), ("secret", " = '"), ("password", "="),
                                   ("Authorization", ": Bearer "), ("access_key", ' => "'))
                for kind in ("hex 40", "HEX 40", "code 32", "hex 32", "code 56", "hex 18", "code 20")]
    positive += [(before, kind, "", 1) for kind in ("access key id", "access key letters", "personal token") for before in ("", "", "use ", "key ", '= "')]
    signs = ((' = "', '"'), (": ", ""), ("=", ""), ('": "', '"'))
    positive += [(name + sign, kind, close, 1) for name in ("aws_secret_access_key", "github_access_token", "GITHUB_CLIENT_SECRET_TOKEN", "database_password")
                 for sign, close in signs for kind in ("hex 40", "code 32", "code 20", "hex 32")]
    short = ("password 10", "password 14", "password marks", "password words")
    positive += [(name + sign, kind, close, 1) for name in ("password", "db_password", "secret", "PASSWD") for sign, close in signs for kind in short]
    positive += [(scheme, kind, "@db/x", 1) for scheme in ("postgres://app:", "https://user:", "amqp://svc:") for kind in short]
    negative = [(name + sign, kind, close, 0) for name in ("password", "token", "secret", "api_key") for sign, close in signs
                for kind in ("long word", "call", "variable", "********")]
    negative += [(before, kind, "", 0) for before, kind in (
        ("commit ", "hex 40"), ("sha256: ", "hex 64"), ("md5 = ", "hex 32"), ("checksum=", "hex 40"), ("uuid ", "uuid"), ("id: ", "uuid"),
        ("card ", "number"), ("", "number"), ("order ", "number"), ("", "words"), ("", "words"), ("", "name"), ("https://", "path"),
        ('token = "', "xxxxxxxxxxxxxxxxxxxxxxxx"), ("password = ", "your-password-goes-here"), ("api_key: ", "name"),
        ("", "----------------------------"))]
    recipes = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(b).alias("name"), F.lit(v).alias("kind"), F.lit(a).alias("close"), F.lit(y).alias("label"))
                        for k, (b, v, a, y) in enumerate(positive + negative)])
    rows = base.withColumn("r", F.explode(recipes)).select("doc_id", "w", "r.*")
    word = lambda i: F.get("w", F.pmod(F.xxhash64("doc_id", "k", F.lit(i)), F.size("w")).cast("int"))
    letters = lambda i: F.regexp_replace(word(i), "[^A-Za-z]", "")
    rows = (rows.withColumn("hex", F.sha2(F.concat_ws("-", F.col("doc_id").cast("string"), F.col("k").cast("string")), 512))
            .withColumn("ws", F.array(*[letters(i) for i in range(4, 8)])))
    piece = lambda at, n: F.substring("hex", at, n)
    code = F.translate(F.base64(F.unhex("hex")), "+/=", "xyz")
    capitals = F.upper(F.translate(piece(1, 16), "01", "qx"))
    values = {"hex 18": piece(1, 18), "code 20": F.substring(code, 1, 20), "access key id": F.concat(F.lit("AKIA"), capitals), "access key letters": F.concat(F.lit("AKIA"), F.translate(piece(1, 16), "0123456789abcdef", "GHJKLMNPQRSTUVWX")),
              "personal token": F.concat(F.lit("ghp_"), F.substring(code, 1, 36)), "hex 32": piece(1, 32), "hex 40": piece(1, 40), "HEX 40": F.upper(piece(1, 40)), "hex 64": piece(1, 64),
              "code 32": F.substring(code, 1, 32), "code 56": F.substring(code, 1, 56),
              "uuid": F.concat_ws("-", piece(1, 8), piece(9, 4), piece(13, 4), piece(17, 4), piece(21, 12)),
              "number": F.concat(F.lit("4"), F.substring(F.translate("hex", "abcdef", ""), 1, 15)),
              "password 10": F.substring(code, 1, 10), "password 14": F.substring(code, 3, 14),
              "password marks": F.concat(F.substring(code, 1, 5), F.lit("&"), F.substring(code, 7, 3), F.lit("!"), F.substring(code, 11, 2)),
              "password words": F.concat(F.lower(letters(4)), F.substring(F.translate("hex", "abcdef", ""), 1, 1), F.lower(letters(5)), F.substring(F.translate("hex", "abcdef", ""), 2, 2)),
              "long word": F.lower(F.concat(letters(4), letters(5))), "call": F.concat(letters(4), F.lit("."), letters(5), F.lit("(request)")),
              "variable": F.concat(F.lit("${"), F.upper(F.array_join("ws", "_")), F.lit("}")),
              "words": F.array_join("ws", ""), "name": F.array_join("ws", "_"), "path": F.array_join("ws", "/")}
    value = F.col("kind")
    for kind, v in values.items():
        value = F.when(F.col("kind") == kind, v).otherwise(value)
    paths = F.array(*[F.lit(p) for p in ("src/app.py", "config/settings.yaml", "docs/page", "web", "")])
    texts = rows.select(F.struct("doc_id", "k").alias("key"), value.alias("value"), F.concat(word(0), F.lit(" "), word(1), F.lit(" "), F.col("name")).alias("before"),
                        F.concat(F.col("close"), F.lit(" "), word(2)).alias("after"),
                        F.get(paths, F.pmod(F.xxhash64("doc_id", "k", F.lit(3)), F.lit(5)).cast("int")).alias("path"), "label")
    texts = cut(texts)  # else every use of the value works it out anew
    texts = texts.select(F.struct("key", F.length("before").alias("at"), F.length("value").alias("n"), "label").alias("id"),
                         F.concat("before", "value", "after").alias("text"), "path")
    # the value, or what the pattern takes of it, has the label; a candidate beside it is no secret
    found = candidates(texts, "id", "text", "path")
    at, end = F.col("doc_id.at"), F.col("doc_id.at") + F.col("doc_id.n")
    inside = (F.col("start") < end) & (F.col("start") + F.length("candidate") > at)
    return found.select("candidate", "before", "after", "path", F.when(inside, F.col("doc_id.label")).otherwise(0).alias("label"))
