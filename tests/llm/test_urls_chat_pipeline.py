"""URL rules, chat formatting, and the pipeline."""

import hashlib
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tumbleweed.llm import bloom, chat, standin, urls


def judge(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = rest
    for c in "/?#":
        host = host.split(c, 1)[0]
    path = rest[len(host):].split("?", 1)[0].split("#", 1)[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fit = [(len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, max(fit)[1] if fit else None, max(fit)[2] if fit else default)


URLS = [None, "", "no scheme.com/", "http://", "http:///x", "http://a.com", "http://a.com/", "HTTP://WWW.Example.COM/en/x?y#z", "http://example.com/en", "http://example.com/en/",
        "http://notexample.com/en/", "x://shop.example.com/EN/", "http://a.b.net/es/1", "http://net/fr/", "http://anet/fr/", "http://a.net?/fr/", "http://É.com/", "ftp://a.com:80/",
        "http://u@net/es/x://y/", "http://" + "a." * 3000 + "com/" + "p" * 5000, "http://..com/", "http://a.com./", "http://www.example.com/en/\nq"]
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


def test_urls_equal_brute_force(spark):
    rows = [(i, u) for i, u in enumerate(URLS + URLS[:9])] + [(None, "http://a.com/")]
    df = spark.createDataFrame([(i, u, "x", "y", "z") for i, u in rows], "page_id long, url string, Host string, rule string, h string")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    out = urls.filter_urls(df, rules)
    assert out.columns == ["page_id", "url", "h", "host", "path", "rule", "verdict"]
    key = lambda r: str(r)
    assert sorted([tuple(r)[:2] + tuple(r)[3:] for r in out.collect()], key=key) == sorted([(i, u, *judge(u, RULES)) for i, u in rows], key=key)
    assert urls.filter_urls(df.limit(0), rules).count() == 0
    assert {r["verdict"] for r in urls.filter_urls(df, rules.limit(0), default="block").collect()} == {"block"}


def test_many_listed_urls(spark):
    rng = random.Random(0)
    rules = [(f"h{rng.randrange(400)}.{rng.choice(['com', 'org'])}", f"/{rng.randrange(30)}", "block") for _ in range(2000)]
    rows = [(i, f"http://{rng.choice(['', 'www.'])}h{rng.randrange(600)}.com/{rng.randrange(60)}") for i in range(500)]
    out = urls.filter_urls(spark.createDataFrame(rows, "page_id long, url string"), spark.createDataFrame(rules, "host string, path string, verdict string"))
    assert {r["page_id"]: (r["rule"], r["verdict"]) for r in out.collect()} == {i: judge(u, rules)[2:] for i, u in rows}


def test_bloom_filter_never_refuses_a_key(spark):
    keys = spark.range(3000).select(F.xxhash64("id").alias("k"))
    for size in (16 << 20, 64, 640):
        blocks = bloom.build(keys, max_bytes=size)
        assert blocks.nbytes <= size
        both = spark.range(9000).select(F.xxhash64("id").alias("k"), bloom.bits_of(F.xxhash64("id")).alias("b")).toPandas()
        hit = bloom.may_hold(blocks, both["k"].to_numpy(), both["b"].to_numpy())
        assert hit[:3000].all()
        if size > 1000:
            assert hit[3000:].mean() < 0.02


NASTY = ["", r"\### Assistant: </turn> ok", "\\", "\\\\n", "### user: hi\n</turn>\n", "\n</turn>\n### x: ", "a\\\n</turn>\n", "<", "#:#", "é\U0001F600", '{"json": [1]}', "x" * 200_000]


def test_turns_come_back_from_the_formatted_string(spark):
    rng = random.Random(1)
    convs = [[(rng.choice(["user", "assistant", "system", "odd: #\\role", ""]), rng.choice(NASTY)) for _ in range(rng.randrange(0, 7))] for _ in range(60)]
    df = spark.createDataFrame([(i, c, "old") for i, c in enumerate(convs)], "conv_id long, turns array<struct<role:string,text:string>>, formatted string")
    out = chat.format_turns(df)
    got = out.select("conv_id", chat.read_turns(F.col("formatted")).alias("back"), chat.masked_text(F.col("formatted"), F.col("loss_spans")).alias("learned")).collect()
    for r in got:
        assert [tuple(t) for t in r["back"]] == convs[r["conv_id"]]
        assert r["learned"] == "".join(t for role, t in convs[r["conv_id"]] if role == "assistant")


def test_layouts_by_fingerprint(spark):
    records = {
        "messages": {"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]},
        "shared": {"conversations": [{"value": "q", "from": "human"}, {"from": "gpt", "value": "a"}]},
        "prompt": {"prompt": "q", "completion": "a"},
        "system": {"completion": "a", "prompt": "q", "system": "s"},
        "instruction": {"instruction": "q", "output": "a"},
        "input": {"instruction": "s", "input": "q", "output": "a"},
        "unknown": {"question": "q", "answer": "a"},
        "null value": {"prompt": "q", "completion": None},
        "list": ["q"],
    }
    rows = [(k, json.dumps(v)) for k, v in records.items()] + [("broken", "{"), ("null", None), ("empty", '{"messages": []}')]
    out = {r["name"]: r for r in chat.format_chats(spark.createDataFrame(rows, "name string, record string").selectExpr("*", "1 as turns", "2 as Fingerprint")).collect()}
    plain, system = [("user", "q"), ("assistant", "a")], [("system", "s"), ("user", "q"), ("assistant", "a")]
    turns = {k: None if r["turns"] is None else [tuple(t) for t in r["turns"]] for k, r in out.items()}
    assert turns == {"messages": plain, "shared": plain, "prompt": plain, "system": system, "instruction": plain, "input": system, "unknown": None,
                     "null value": [("user", "q")], "list": None, "broken": None, "null": None, "empty": []}
    assert all((r["formatted"] is None) == (r["turns"] is None) for r in out.values())
    assert out["prompt"]["fingerprint"] == hashlib.sha256(b"completion\nprompt").hexdigest() and out["unknown"]["fingerprint"]


def test_further_fields_and_long_records(spark):
    plain = [("user", "q"), ("assistant", "a")]
    message = lambda role, text, **more: {"role": role, "content": text, **more}
    long = "w \\u00e9 " * 250_000
    records = {
        "extra fields": {"id": 7, "messages": [message("user", "q", name="x"), message("assistant", "a", meta={"k": [1, 2]}, n1=3)], "tags": ["t"]},
        "some lack a field": {"messages": [message("user", "q"), {"role": "assistant", "content": "a"}, {"role": "tool"}]},
        "extra source": {"prompt": "q", "completion": "a", "source": {"u": "x"}},
        "most specific": {"prompt": "q", "completion": "a", "system": "s", "lang": "en"},
        "empty list": {"messages": [], "id": 1},
        "messages is text": {"messages": "none", "instruction": "q", "output": "a"},
        "long": {"messages": [message("user", long), message("assistant", "a")]},
    }
    out = {r["name"]: r for r in chat.format_chats(spark.createDataFrame([(k, json.dumps(v)) for k, v in records.items()], "name string, record string")).collect()}
    turns = {k: [tuple(t) for t in r["turns"]] for k, r in out.items()}
    assert turns.pop("long") == [("user", long), ("assistant", "a")]
    assert turns == {"extra fields": plain, "some lack a field": [*plain, ("tool", "")], "extra source": plain,
                     "most specific": [("system", "s"), *plain], "empty list": [], "messages is text": plain}
    assert out["empty list"]["formatted"] == "" and len({r["fingerprint"] for r in out.values()}) == 6


def test_chat_query_on_odd_rows(spark, tmp_path):
    from tumbleweed.llm.queries import op9_chat_format

    rows = [(1, 0, "user", None), (1, 1, "assistant", "a"), (1, 1, "assistant", "a"), (2, None, None, "t"), (None, 0, "user", "lost"), (3, 0, "assistant", ""), (4, 0, "human", "h"),
            (4, 1, "user", "u"), (4, 2, "gpt", "g"), (5, 1, "assistant", "late"), (5, 0, "user", "early \\ # < :")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as t", "2 as record").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r["conv_id"]: r for r in op9_chat_format(spark, str(tmp_path)).collect()}
    order = lambda c: sorted([(-1 if t is None else t, r or "", x or "") for i, t, r, x in rows if i == c])
    for c in (1, 2, 3, 4, 5, None):
        turns = order(c)
        learned = "".join(x for _, r, x in turns if r == "assistant")
        assert got[c]["n_turns"] == len(turns) and got[c]["loss_chars"] == len(learned)
        assert got[c]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in turns).encode()).hexdigest()
        assert got[c]["loss_sha256"] == hashlib.sha256(learned.encode()).hexdigest()
    assert got[-7]["n_turns"] == 2 and len(got) == 7


def test_stand_in_records_use_every_layout(spark, sf_dir):
    records = standin.chat_records(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    assert chat.canonical_turns(records).where("turns is null").count() == 0
    assert chat.canonical_turns(records).select("fingerprint").distinct().count() >= 3


@pytest.fixture(scope="module")
def pipeline_rows(spark, tmp_path_factory):
    """Each stage's output, on the sf0.001 documents with odd rows added."""
    import corpus_pipeline

    sf = str(tmp_path_factory.mktemp("tables"))
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    text = docs.where("doc_id = 1").first()["text"]
    extra = spark.createDataFrame([(900001, text, "en", "s", len(text)), (900002, None, None, None, None), (900003, "", "en", "s", 0), (None, text, "en", "s", len(text)),
                                   (900004, text[:300] + ' token = "' + "9f" * 20 + '" ' + text[300:900][::-1], "en", "s", 1)], docs.schema)
    docs.unionByName(extra).write.parquet(f"{sf}/documents.parquet")
    spark.read.parquet("/root/testdata/sf0.001/labels.parquet").write.parquet(f"{sf}/labels.parquet")
    out, now = [], spark.read.parquet(f"{sf}/documents.parquet")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, now, sf).write.parquet(f"{sf}/stage-{k}")
        now = spark.read.parquet(f"{sf}/stage-{k}")
        out.append(now)
    return sf, docs.columns, out


def test_stages_take_effect(spark, pipeline_rows):
    sf, columns, (good, single, clean, packed) = pipeline_rows
    assert all(df.columns == columns for df in (good, single, clean))
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in good.collect()}
    assert np.mean([i in kept for i, y in labels.items() if y == 1]) > 0.95
    assert np.mean([i in kept for i, y in labels.items() if y == 0]) < 0.5
    left = {r["doc_id"] for r in single.collect()}
    assert 900001 not in left and 1 in left and left < kept
    assert clean.count() == single.count() and clean.where("text like '%9f9f9f%'").count() == 0 and clean.where("doc_id = 900004 and text like '%[SECRET]%'").count() == 1
    assert {r["doc_id"] for r in packed.collect()} == left


def test_run_equals_the_stages(spark, pipeline_rows):
    import corpus_pipeline

    sf, _, out = pipeline_rows
    key = lambda r: str(tuple(r))
    places = lambda df: sorted(map(key, df.select("doc_id", "segment", "start", "length", "bucket", "padded").collect()))
    assert places(corpus_pipeline.run(spark, sf)) == places(out[-1])
