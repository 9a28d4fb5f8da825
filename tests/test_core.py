import ipaddress
import random
import re

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusmill.functions import text as tx
from corpusmill.operators import commits, decontamination, dedup, entities, filters, graph, issues, languages, markup, minhash, notebooks, pii, spans, statistics
from corpusmill.operators.graph import connected_components
from corpusmill.plans import registry
from corpusmill.sources import benchmarks, io

SF = "/root/testdata/sf0.001"


def one(spark, column, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]) if values else spark.range(1)
    return df.select(column).first()[0]


def test_star_buckets(spark):
    df = spark.createDataFrame([(v,) for v in (None, 0, 1, 10, 11, 100, 101, 1000, 1001)], "s int")
    assert [r[0] for r in df.select(tx.stars_bucket(F.col("s"))).collect()] == ["0", "0", "1-10", "1-10", "10-100", "10-100", "100-1000", "100-1000", "1000+"]


def test_shingles_and_hashes(spark):
    tokens = F.array(*map(F.lit, "abcd"))
    assert one(spark, tx.ngrams(tokens, 2)) == ["a b", "b c", "c d"]
    assert one(spark, tx.ngrams(tokens, 5)) == []
    assert one(spark, tx.sha1_hash32(F.lit("hello"))) == 499578026
    assert sorted(minhash.shingle_hashes("a b c d", 2, 1, "v2").tolist()) == [145323813, 433422276, 459146835]
    assert minhash.shingle_hashes("a b", 3, 1, "v2").tolist() == [433422276]
    assert minhash.shingle_hashes("a b c d", 2, 5, "v2").tolist() == []


@pytest.mark.parametrize("choice", [(0.7, 256, 25, 10), (0.7, 250, 25, 10), (0.58, 128, 21, 6), (0.8, 256, 17, 15)])
def test_band_choice(choice):
    assert minhash.band_choice(*choice[:2]) == choice[2:]


def test_signature_of_no_shingle():
    assert set(minhash.signature(np.empty(0, np.uint64), minhash.permutations(4), "v1").tolist()) == {0xFFFFFFFF}


def test_evaluation_golden(spark):
    refs = spark.createDataFrame([(1, "KEY", 99, 110), (1, "KEY", 9, 22), (1, "EMAIL", 0, 7), (1, "EMAIL", 10, 20)], "doc_id int, tag string, start int, end int")
    preds = spark.createDataFrame([(1, "KEY", 99, 112), (1, "EMAIL", 1, 7), (1, "EMAIL", 99, 119)], "doc_id int, tag string, start int, end int")
    counts = spans.match_counts(refs, preds)
    by = {r.tag: (r.recall, r.precision) for r in spans.rates(counts).collect()}
    assert by == {"KEY": (0.5, 1.0), "EMAIL": (0.5, 0.5)}
    total = spans.overall(counts).first()
    assert total.recall == 0.5 and round(total.precision, 2) == 0.67


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 12), st.integers(0, 12)), max_size=25))
def test_components_match_union_find(spark, edges):
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    found = {r.id: r.component for r in connected_components(spark.createDataFrame(edges, "src int, dst int")).collect()}
    assert found == {x: root(x) for x in parent}


def test_keep_best_by_rank_keys(spark):
    rows = [(1, "non_permissive", 9, 9), (2, "permissive", 1, 1), (3, "permissive", 2, None), (4, None, 99, 99)]
    docs = spark.createDataFrame(rows, "doc_id int, license string, stars int, forks int").withColumn("t", F.lit(None).cast("timestamp"))
    components = spark.createDataFrame([(i, 1) for i in (1, 2, 3)], "id int, component int")
    order = dedup.rank_keys(F.col("license"), F.col("stars"), F.col("forks"), F.col("t"), F.col("t"))
    assert sorted(r.doc_id for r in dedup.keep_best(docs, components, order).collect()) == [3, 4]


def test_filters_and_report(spark):
    df = spark.createDataFrame([(1, "<?xml version='1'?> ok words", 300), (2, "fine words here", 300), (3, "!" * 90 + "a", 300), (4, None, 300), (5, "fine", 50)], "doc_id int, text string, n int")
    kept, report = filters.run_chain(df, [filters.basic(), filters.xml(), filters.size_between("n")], "n")
    assert sorted(r.doc_id for r in kept.collect()) == [2, 4]
    assert [(r.name, r.rows_before, r.rows_after) for r in report.orderBy("step").collect()] == [("basic", 5, 4), ("xml", 4, 3), ("large_and_small_files", 3, 2)]
    assert filters.resolve("x*,basic") == ["basic", "xml"]


def test_truncation_and_bots(spark):
    text = "\n".join(map(str, range(81)))
    cut = one(spark, issues.truncate(F.lit(text))).split("\n")
    assert len(cut) == 81 and cut[59:62] == ["59", "[Truncated]", "61"]
    events = [("a", "hi"), ("x-bot", "first"), ("b", "/run"), ("c", "see"), ("b", "/run x-bot"), ("x-bot", "done"), ("d", "end")]
    e = F.array(*[F.struct(F.lit(a).alias("author"), F.lit(t).alias("text")) for a, t in events])
    assert [x.text for x in one(spark, issues.without_bots(e))] == ["hi", "/run", "see", "end"]
    masked = one(spark, issues.masked(F.array(*[F.struct(F.lit(a).alias("author"), F.lit(t).alias("text")) for a, t in [("ann", "hi bob"), ("bob", "ann?")]])))
    assert [(x.author, x.text) for x in masked] == [("username_0", "hi username_1"), ("username_1", "username_0?")]


def test_detection_and_redaction(spark):
    text = 'mail me at jane.doe@example.org, host 93.184.216.34 and 10.0.0.1\ntoken = "0123456789abcdef0123456789abcdefdeadbeef" v 1.2.3.4 x'
    df = spark.createDataFrame([(1, text), (2, None), (3, "")], "doc_id int, text string")
    scanned = pii.scan(df)
    found = {r.doc_id: [(s.tag, s.value) for s in r.secrets] for r in scanned.collect()}
    assert ("EMAIL", "jane.doe@example.org") in found[1] and ("IP_ADDRESS", "93.184.216.34") in found[1]
    assert ("IP_ADDRESS", "1.2.3.4") not in found[1] and any(t == "KEY" for t, _ in found[1])
    assert found[2] == found[3] == []
    out = {r.doc_id: r for r in pii.redact(scanned, pii.POOLS).collect()}
    assert "jane.doe" not in out[1].new_content and "93.184" not in out[1].new_content and "10.0.0.1" in out[1].new_content
    assert not out[2].modified and out[2].new_content is None


def test_private_addresses(spark):
    values = {"10.1.2.3": True, "192.168.0.1": True, "8.8.8.8": False, "172.32.0.1": False, "1.2.3": False, "256.1.1.1": False}
    for value, private in values.items():
        assert one(spark, tx.is_private_ipv4(F.lit(value))) is private


def test_line_diff_and_commit_text(spark):
    assert commits.line_diff("a\nb\nc", "a\nx\nc\nd") == (0, 3, 3, 0, 4, 4, 2, 1, 3)
    assert commits.line_diff(None, "") == (0,) * 9
    text = one(spark, commits.content_with_meta(F.lit(1), F.lit("body"), F.lit("r"), F.lit("f"), F.lit("0"), share=1.0))
    assert text == "<reponame>r<filename>f<gh_stars>0\nbody"


def test_notebook_cells(spark):
    content = '{"metadata": {"kernelspec": {"name": "python3"}}, "cells": [{"cell_type": "markdown", "source": ["# T\\n", "x"]}, {"cell_type": "code", "source": "1+1", "outputs": [{"text": ["2"]}]}, {"cell_type": "code", "source": ""}]}'
    cells = one(spark, notebooks.parse_cells(F.lit(content)))
    assert [(c.type, c.src, c.out) for c in cells] == [("markdown", "# T\nx", notebooks.NO_OUTPUT), ("code", "1+1", "2")]
    assert one(spark, notebooks.parse_cells(F.lit("broken"))) is None
    assert one(spark, notebooks.script_extension(F.lit(content))) == ".py"


def test_markup():
    assert markup.visible_text("<p>a<script>x</script>b</p>") == "ab"
    assert markup.python_comments('"""doc"""\n# note\nx = 1\n') == "note\ndoc"
    assert markup.python_comments("def (") == ""


def against_statement(spark, name, folder, **tables):
    """Sorted rows of a query and of its statement over ``tables``."""
    db = duckdb.connect()
    for t, df in tables.items():
        df.write.parquet(f"{folder}/{t}.parquet")
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet/*.parquet'")
    found = registry.queries()[name](spark, str(folder))
    theirs = db.execute(f"SELECT {', '.join(found.columns)} FROM ({registry.oracle_sql()[name]})").fetchall()
    shown = lambda rows: sorted((tuple("nan" if v != v else v for v in r) for r in rows), key=str)
    return shown(found.collect()), shown(theirs)


def test_comment_ratio_of_empty_first_lines(spark, tmp_path):
    assert markup.python_comments('""""""\n# \nx = 1\n') == "\n"
    rows = [(1, "", 0), (2, "", 1), (3, "\nabc", 4), (4, "\u00e9\u00e9", 2), (5, None, 2), (6, "abc", 4), (7, "abc", None)]
    ours, theirs = against_statement(spark, "comment_ratio", tmp_path, documents=spark.createDataFrame(rows, "doc_id long, text string, n_chars long"))
    assert ours == theirs


def test_filter_basic_of_odd_texts(spark, tmp_path):
    rows = [None, "", "\n", "abc", "...a", "....a", "!!!\u0870", "!!\u05d0\u088f", "!!!\U00010570", "!!!\U00011f50", "!!!\u20ac", "a" * 1000, "a" * 1001, "b" * 100 + "\nb" * 101]
    documents = spark.createDataFrame([(i, t, 8) for i, t in enumerate(rows)], "doc_id long, text string, n_chars long")
    ours, theirs = against_statement(spark, "filter_basic", tmp_path, documents=documents)
    assert ours == theirs
    assert one(spark, tx.alpha_count(F.lit("a\u0870\U00010570\U00011f501 "))) == 3


@pytest.mark.parametrize("case", ["odd", "dropped", "empty", "unsized", "tie"])
def test_filter_chain_report_of_odd_tables(spark, tmp_path, case):
    rows = {
        "odd": [(None, 300), ("", 0), ("fine words", 300), ("fine", None), ("<?xml version='1'?> ok", 22), ("short", 5), ("!!!!!!!!a", 9)],
        "dropped": [("", 0), ("!!!!!", 5)],
        "empty": [],
        "unsized": [("fine words", None)],
        "tie": [("fine words", 209), ("!!!!!", 20_000 - 209)],
    }[case]
    documents = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, text string, n_chars long")
    ours, theirs = against_statement(spark, "filter_chain_report", tmp_path, documents=documents)
    assert ours == theirs


def test_sources_and_sinks(spark, tmp_path):
    df = spark.range(50).withColumn("lang", F.when(F.col("id") % 2 == 0, "a").otherwise("b"))
    assert io.partitioned_save(df, f"{tmp_path}/p", chunk=20, most=4, least=1) == 3
    assert io.read_corpus(spark, f"{tmp_path}/p").count() == 50
    assert io.save_shards(df, f"{tmp_path}/s", "id", 10, 5) == 3
    io.save_by(df, f"{tmp_path}/l")
    assert io.read_corpus(spark, f"{tmp_path}/l", subset="lang=a").count() == 25
    io.save_jsonl(df, f"{tmp_path}/j")
    assert io.read_jsonl(spark, f"{tmp_path}/j").count() == 50


def test_language_owners(spark):
    pairs = spark.createDataFrame([("C", ".h"), ("C++", ".h"), ("PLSQL", ".sql"), ("HyPhy", ".bf")], "name string, extension string")
    assert sorted(map(tuple, languages.resolve(pairs).collect())) == [("C", ".h"), ("SQL", ".sql")]


def test_mail_is_stripped(spark):
    cases = {
        "> quoted\nmy answer": "my answer",
        "hello\nOn 1/2/2020 10:30 AM Bob wrote\n> old\nnew": "hello\nnew",
        "one\nsee notifications@github.com\nPlease Reply to this email directly now\ntwo": "one\ntwo",
        "a\n> quoted:\nkeep me": "keep me",
        "x\nReply to this email directly:\ndropped\ny": "y",
        "  plain text  ": "plain text",
        "text From: a\nReply to this email directly, or view it on GitHub<u>\nrest": "text",
        "work\n\nSigned-off-by: A <a@b.c>\nmore": "work\n\nmore",
        "a\n____________________________\nb": "a\n\nb",
        "one\ntwo 3/4/2021 09:15 PM she wrote": "one\none\ntwo 3/4/2021 09:15 PM she wrote",
    }
    df = spark.createDataFrame(list(cases.items()), "t string, want string")
    for r in df.select("t", "want", issues.strip_mail(F.col("t")).alias("got")).collect():
        assert r.got == r.want, r.t
    assert one(spark, issues.strip_mail(F.lit(None).cast("string"))) == ""


def test_issue_chain_reports_every_step(spark):
    events = lambda rows: [{"author": a, "text": t} for a, t in rows]
    rows = [(1, events([("ann", "x" * 150), ("bob", "hi ann" + "y" * 60)])), (2, events([("ci-bot", "z" * 900)])), (3, events([("cat", "short")]))]
    kept, report = issues.run_pipeline(spark.createDataFrame(rows, "id int, events array<struct<author:string,text:string>>"))
    (r,) = kept.collect()
    assert (r.id, r.text_size, r.user_count, r.event_count, r.modified_usernames, r.modified_by_bot) == (1, 216, 2, 2, True, False)
    assert r.events[1].text.startswith("hi username_0")
    assert [(x.name, x.rows, x["size"]) for x in report.orderBy("step").collect()] == [("loaded", 3, 1121), ("truncate", 3, 1121), ("bots", 2, 221), ("users and size", 1, 216)]


def test_private_addresses_of_version_six(spark):
    draw = random.Random(3)
    known = ["::1", "::", "fd00::1", "fe80::1%", "2001:db8::5", "2001:4860:4860::8888", "2002::1", "2001:20::1", "2001:30::", "2001:3::9", "64:ff9b:1::2", "::ffff:1:2", "1:2:3:4:5:6:7:8", "1::2::3", ":::", "12345::", "g::1", "1:2", ""]
    known += [":".join(f"{draw.choice([0, 1, draw.randrange(1 << 16)]):x}" for _ in range(8)) for _ in range(300)]
    known += [str(ipaddress.IPv6Address(draw.choice([0xFC << 120, 0x2001 << 112, 0xFE80 << 112, 0x20010DB8 << 96, 0]) | draw.getrandbits(100))) for _ in range(300)]

    def want(text):
        try:
            return True, ipaddress.IPv6Address(text).is_private
        except ValueError:
            return False, False

    df = spark.createDataFrame([(k,) for k in known], "v string").select("v", tx.is_ipv6(F.col("v")).alias("a"), tx.is_private_ip(F.col("v")).alias("b"))
    for r in df.collect():
        valid, private = want(r.v)
        if "%" not in r.v and "." not in r.v:
            assert (r.a, r.b) == (valid, private), r.v


def test_redaction_keeps_private_addresses_and_gives_references(spark):
    text = "to a@b.org and a@b.org from fd00::1 2606:4700::1111 8.8.8.8 10.0.0.1 9.9.9.1"
    spans_of = [("EMAIL", "a@b.org", 3, 10), ("EMAIL", "a@b.org", 15, 22), ("IP_ADDRESS", "fd00::1", 28, 35), ("IP_ADDRESS", "2606:4700::1111", 36, 51), ("IP_ADDRESS", "8.8.8.8", 52, 59), ("IP_ADDRESS", "10.0.0.1", 60, 68), ("IP_ADDRESS", "9.9.9.1", 69, 76)]
    struct = "doc_id int, text string, secrets array<struct<tag:string,value:string,start:int,end:int>>"
    rows = spark.createDataFrame([(1, text, spans_of), (2, "plain", []), (3, "see 10.0.0.1", [("IP_ADDRESS", "10.0.0.1", 4, 12)]), (4, None, None)], struct)
    out = {r.doc_id: r for r in pii.redact(rows, pii.POOLS).collect()}
    new = out[1].new_content
    six = re.search(r"2001:db8::\d", new)[0]
    mail = re.search(r"user\d@example.com", new)[0]
    four = re.search(r"198.51.100.\d", new)[0]
    assert new == f"to {mail} and {mail} from fd00::1 {six} 8.8.8.8 10.0.0.1 {four}"
    assert out[1].references == f"to PI:EMAIL:{mail}END_PI and PI:EMAIL:{mail}END_PI from fd00::1 PI:IP_ADDRESS:{six}END_PI 8.8.8.8 10.0.0.1 PI:IP_ADDRESS:{four}END_PI"
    assert (out[2].new_content, out[2].references, out[2].modified) == ("plain", "plain", False)
    assert (out[3].new_content, out[3].references, out[3].modified) == ("see 10.0.0.1", "", False)
    assert out[4].new_content is None and not out[4].modified
    plan = pii.redact(pii.scan(rows.drop("secrets")), pii.POOLS).where("modified")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_formats_of_secrets():
    found = lambda text: [(v, text[a:b] == v) for t, v, a, b in pii.detect(text) if t == "KEY"]
    hexed, mixed = "9f86d081884c7d659a2feaa0c55ad015a3bf4f1b", "Zx8qLw3RtY6uPn2VbK5sDf7GhJ4mAc9E"
    values = ["AKIA" + "Q7T2" * 4, "ghp_" + "a1B2" * 9, "xoxb-123456789012-abcdef", "sk_live_" + "a1B2" * 6, "SG." + "a" * 22 + "." + "b" * 43, "a1b2c3d4" * 4 + "-us12", "AC" + "9f8e7d6c" * 4, "npm_" + "a1B2" * 9, "AKCp8jQcoDRqX7"]
    for value in values:
        assert found(f"key {value} end") == [(value, True)], value
    assert found(f'token = "{mixed}"') == [(mixed, True)] and found(f'x = "{hexed}"') == [(hexed, True)]
    assert found(f'sha1 "{hexed}"') == found('x = "123e4567-e89b-12d3-a456-426614174000"') == found('token = "abcdefghijklmnopqrst"') == found(f'user_id = "{hexed}"') == []


def test_rules_for_model_entities(spark):
    model = pii.BigramModel(["password", "token", "secret", "keyword", "banana", "another", "ordinary", "words"] * 20, threshold=-3.0)
    rows = [("KEY", "qzxjkvwqpzx", True), ("KEY", "anotherword", False), ("KEY", "qzxj", False), ("NAME", "Ann Lee", True), ("NAME", "Annabel", False), ("USERNAME", "ann_lee", False), ("IP_ADDRESS", "2606:4700::1111", True), ("IP_ADDRESS", "fd00::1", False), ("IP_ADDRESS", "93.184.216.34", True), ("IP_ADDRESS", "1.1.1.1", False), ("EMAIL", "a@b", False)]
    e = F.array(*[F.struct(F.lit(t).alias("tag"), F.lit(v).alias("value"), F.lit(0).alias("start"), F.lit(1).alias("end")) for t, v, _ in rows])
    kept = one(spark, pii.ner_rules(e, model))
    assert [(x.tag, x.value) for x in kept] == [(t, v) for t, v, ok in rows if ok]
    for value in ("qzxjkv", "another", "a", "..", "Ab1cd"):
        score = one(spark, pii.gibberish_score(F.lit(value), model))
        assert score is None and model.score(value) == float("-inf") or abs(score - model.score(value)) < 1e-9


def test_components_of_a_long_path_take_few_rounds(spark, monkeypatch):
    rounds = []
    kept = graph.materialize
    monkeypatch.setattr(graph, "materialize", lambda df, label: (rounds.append(label), kept(df, label))[1])
    path = spark.range(2000).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"))
    found = connected_components(path)
    assert found.where("component <> 0").count() == 0 and found.count() == 2001
    assert rounds.count("pointers") < 20


def test_missing_key_splits_the_tree(spark, tmp_path):
    spark.createDataFrame([(k,) for k in range(1, 30) if k != 4], "o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    found = {r.id: r.component for r in registry.queries()["graph_components"](spark, str(tmp_path)).collect()}
    assert found == {k: 4 if k in (4, 12, 13, 14) else 0 for k in range(30)}


def test_signatures_equal_brute_force():
    draw = np.random.Generator(np.random.PCG64(1))
    for variant, kind in (("v1", np.uint64), ("v2", np.uint32)):
        perms = minhash.permutations(16, variant)
        sets = [draw.integers(0, 1 << 32, n, dtype=np.uint64).astype(kind) for n in (0, 1, 5, 40_000, 3, 0, 20_000, 7)]
        for hashes, found in zip(sets, minhash.signatures(sets, perms, variant), strict=True):
            for a, b, x in zip(*perms.tolist(), found.tolist(), strict=True):
                if variant == "v1":
                    want = min(((h * a + b) % (1 << 64) % minhash.MERSENNE_61 & minhash.MASK_32 for h in hashes.tolist()), default=minhash.MASK_32)
                else:
                    want = min(((h * a + b) % (1 << 32) % minhash.PRIME_32 for h in hashes.tolist()), default=minhash.MASK_32)
                assert x == want


def test_second_variant_equals_brute_force(spark):
    """Signatures, bands, stars and union-find in plain Python against the query, over whole texts."""
    docs = {r.doc_id: r.text for r in registry.table(spark, SF, "documents").collect()}
    perms, (bands, rows) = minhash.permutations(250, "v2"), minhash.band_choice(0.7, 250)
    buckets, parent = {}, {i: i for i in docs}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in sorted(docs):
        sig = minhash.signature(minhash.shingle_hashes(docs[i], 5, 5, "v2"), perms, "v2")
        for band in range(bands):
            a, b = sorted((root(i), root(buckets.setdefault((band, sig[band * rows : (band + 1) * rows].tobytes()), i))))
            parent[b] = a
    assert sorted(r.doc_id for r in registry.queries()["dedup_v2"](spark, SF).collect()) == [i for i in sorted(docs) if root(i) == i]


def test_matches_tell_rows_of_one_id_apart(spark):
    docs = spark.createDataFrame([(1, "a clean text of its own"), (1, "here the needle of five words stands"), (2, "nothing")], "doc_id int, text string")
    needles = spark.createDataFrame([("b", 1, "the needle of five words")], "benchmark string, ord int, needle string")
    assert [(r.doc_id, r.ord) for r in decontamination.substring_matches(docs, needles).collect()] == [(1, 1)]
    items = spark.createDataFrame([(7, "here the needle of five words stand"), (8, None), (9, "")], "item_id int, text string")
    assert [(r.doc_id, r.item_id) for r in decontamination.jaccard_pairs(docs, items).collect()] == [(1, 7)]
    assert decontamination.lsh_pairs(docs, items, 0.3).where("item_id = 7 and doc_id = 1").count() == 1


def test_chains_of_consecutive_rows(spark):
    keys = [draw for draw in "aabbbaccccdaab" * 7]
    rows = spark.createDataFrame([(k, i, str(i % 10)) for i, k in enumerate(keys)], "k string, pos int, t string").repartition(5)
    want, start = [], 0
    for i in range(1, len(keys) + 1):
        if i == len(keys) or keys[i] != keys[i - 1]:
            want.append((keys[start], start, "<jupyter_start>" + "".join(str(j % 10) for j in range(start, i)), i - start))
            start = i
    assert sorted(map(tuple, notebooks.chain(rows, "k", "pos", "t").collect()), key=lambda r: r[1]) == want
    assert notebooks.chain(rows.where("false"), "k", "pos", "t").count() == 0


def test_statistics_over_ranges(spark):
    values = [5.0, 1.0, 1.0, 9.0, 7.0, None, 3.0, 3.0]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "v double, i int")
    found = {r.p: r.value for r in statistics.percentiles(df, "v", [0, 25, 50, 99, 100]).collect()}
    clean = [v for v in values if v is not None]
    assert all(abs(found[p] - np.percentile(clean, p)) < 1e-9 for p in found) and len(found) == 5
    assert sorted(r.idx for r in statistics.row_index(df, ["i"]).collect()) == list(range(8))
    assert statistics.percentiles(df.where("false"), "v", [50]).count() == 0
    logs = spark.createDataFrame([("found ext foo",), ("found ext foo",), ("found ext bar",)], "value string")
    assert sorted(map(tuple, statistics.unrecognized(logs, r"ext (\w+)").collect())) == [("bar", 1), ("foo", 2)]
    stats = statistics.log_statistics(logs, {"ext": r"ext (\w+)"})
    assert statistics.log_cardinality(stats, {"ext": 2}).count() == 0 and statistics.log_cardinality(stats, {"ext": 1, "none": 1}).count() == 2


def test_remapped_scores():
    # old tokens end at 3, 5, 9; new tokens at 5, 7, 9, 12
    assert entities.remap([5, 7, 9, 12], [3, 5, 9], [[1.0, 0.0], [0.0, 1.0], [0.5, 0.5]]) == [[0.5, 0.5], [0.5, 0.5], [0.5, 0.5], None]
    assert entities.remap([3, 5], [5], [[0.25]]) == [[0.25], [0.25]]
    assert entities.remap([2], [], []) == [None]


def test_entity_edges(spark):
    cases = [("EMAIL", '"<a@b.c>;', 2, 7), ("KEY", "'abc=='", 1, 7), ("NAME", "Ann é.. ", 0, 5), ("NAME", "...", 0, 0)]
    df = spark.createDataFrame([(t, v, 0, len(v), a, b) for t, v, a, b in cases], "tag string, value string, start int, end int, a int, b int")
    for r in df.select("value", "a", "b", entities.trimmed(F.struct("tag", "value", "start", "end")).alias("e")).collect():
        assert (r.e.start, r.e.end) == (r.a, r.b) and r.e.value == r.value[r.a : r.b], r.value


def test_benchmark_sources(spark, tmp_path):
    (tmp_path / "tasks.jsonl").write_text("".join(f'{{"task_id": {i}, "text": " t{i} "}}\n' for i in range(1, 31)))
    found = benchmarks.read_tasks(spark, str(tmp_path / "tasks.jsonl"), "text", ids=(11, 20), expected=10)
    assert sorted(map(tuple, found.collect())) == [(i, f"t{i}") for i in range(11, 21)]
    with pytest.raises(ValueError):
        benchmarks.read_tasks(spark, str(tmp_path / "tasks.jsonl"), "text")
    (tmp_path / "prompt.txt").write_text("do this\nBEGIN SOLUTION\nthat")
    assert [r.text for r in benchmarks.read_prompts(spark, str(tmp_path / "prompt.txt")).collect()] == ["do this\n"]
    (tmp_path / "languages.json").write_text('["C", "Zig"]')
    assert sorted(r.name for r in benchmarks.read_languages(spark, str(tmp_path / "languages.json")).collect()) == ["C", "Zig"]
    spark.createDataFrame([([" a ", ""], "b")], "solutions array<string>, prompt string").write.parquet(f"{tmp_path}/hub")
    assert sorted(r.text for r in benchmarks.read_columns(spark, f"{tmp_path}/hub", ["solutions", "prompt"]).collect()) == ["a", "b"]
    docs = spark.createDataFrame([(1, "the needle of five words here", "en"), (2, "clean", "fr")], "doc_id long, text string, lang string")
    needles = spark.createDataFrame([("b", 1, "the needle of five words")], "benchmark string, ord long, needle string")
    assert [x.count() for x in benchmarks.read_evidence(spark, f"{tmp_path}/none")] == [0, 0]
    matches = decontamination.substring_matches(docs, needles)
    benchmarks.save_evidence(f"{tmp_path}/e", needles, matches, docs)
    benchmarks.save_both(*decontamination.split_by_matches(docs, matches), f"{tmp_path}/both")
    assert spark.read.parquet(f"{tmp_path}/both/removed").count() == spark.read.parquet(f"{tmp_path}/both/kept").count() == 1
    searched, known = benchmarks.read_evidence(spark, f"{tmp_path}/e")
    again = decontamination.incremental_matches(docs, needles, searched, known)
    assert [tuple(r) for r in again.collect()] == [(1, "the needle of five words")]
    assert [tuple(r) for r in spark.read.json(f"{tmp_path}/e/meta").select("lang", "filter_reason", "n").collect()] == [("en", "b_match", 1)]


def test_shared_folder_is_asked_for_on_a_cluster():
    from types import SimpleNamespace

    from corpusmill.sources.shared import shared_dir

    conf = SimpleNamespace(get=lambda *a: None)
    cluster = SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(getConf=lambda: conf, master="spark://host:7077"))
    with pytest.raises(RuntimeError):
        shared_dir(cluster)


def test_token_spans_are_found_once_in_bounded_blocks(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(entities, "SPAN_BLOCK", 7)
    rows = [(1, "a_b+c. (d)"), (2, None), (3, "e\u0301x\u00a0y\n"), (4, ""), (5, "\u00e9" * 9), (6, " \t"), (7, "- " * 50)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    found = {r.doc_id: [tuple(x) for x in r.s] for r in df.select("doc_id", entities.token_spans(F.col("text")).alias("s")).collect()}
    assert found == {i: [m.span() for m in re.finditer(r"[\w+.\-]+|\S", t or "")] for i, t in rows}
    df.write.parquet(f"{tmp_path}/documents.parquet")
    result = registry.queries()["token_spans"](spark, str(tmp_path))
    assert result._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert sorted(map(tuple, result.collect())) == sorted(db.execute(registry.oracle_sql()["token_spans"]).fetchall())


def test_html_diff(spark):
    assert "diff_add" in one(spark, commits.html_diff("a", "b"), a="x\ny", b="x\nz")


QUERIES = ["row_index", "size_percentiles", "average_precision", "issue_report", "concat_islands", "notebook_cells", "email_hits", "ipv4_hits", "many_hashes", "secret_context_hash", "entity_trim", "pseudo_labels", "training_entities", "entity_scores", "dedup_keep_min", "dedup_keep_best", "decontam_lsh", "line_stats", "filter_chain_report", "filter_per_extension", "decontam_substring", "decontam_jaccard", "bio_label", "pair_turns", "commit_filter", "lang_ext_resolve", "eval_intervals"]


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_its_sql(spark, name):
    db = duckdb.connect()
    for t in ("documents", "benchmark", "conversations", "labels", "events", "orders"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    found = registry.queries()[name](spark, SF)
    columns = sorted(found.columns)
    show = lambda v: f"{v:.9g}" if isinstance(v, float) else str(v)
    ours = sorted(tuple(show(r[c]) for c in columns) for r in found.collect())
    theirs = db.execute(registry.oracle_sql()[name])
    names = [d[0] for d in theirs.description]
    assert ours == sorted(tuple(show(r[names.index(c)]) for c in columns) for r in theirs.fetchall())
