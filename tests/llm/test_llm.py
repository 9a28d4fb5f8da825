import base64
import collections
import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from corpusmill.llm import binary_ids, bpe_sql, exact_dedup, html_text, lattice_lm, line_templates, near_dup, packing, quality, token_counts, tokens

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, row string"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def texts():
    draw = random.Random(7)
    sentence = lambda n: " ".join(draw.choice(WORDS) + draw.choice(["", "", "s", "ing", str(draw.randrange(50))]) for _ in range(n))
    base = [sentence(draw.randrange(30, 120)) + "\n" + sentence(25) for _ in range(24)]
    near = [base[0].replace("alpha", "omega", 1), base[1] + " tail"]
    odd = ["", "  \n\t ", "one", "it's <|endoftext|> 'll\n\n  x", "é日本 \xa0 x\x85y ½", "z" * 3000, "a b c d", "line user 17 logged in\n" * 3]
    logs = [f"job {i} finished in {i}ms on host h{i}\n{sentence(30)}" for i in range(12)]
    return base + base[:3] + [base[0].replace(" ", "  ")] + near + odd + logs


@pytest.fixture(scope="module")
def rows():
    found = [(i, t, "en", f"src{i % 2}", len(t), "clash", "clash") for i, t in enumerate(texts())]
    return [*found, (900, None, None, None, None, None, None), found[5]]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def unique(spark, rows):
    return spark.createDataFrame(rows[:-1], SCHEMA).repartition(3)


def library(name):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(name))


def duck(rows, sql):
    db = duckdb.connect()
    db.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    db.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", [r[:5] for r in rows])
    return sorted(db.execute(sql).fetchall())


def test_token_counts(docs, rows, empty):
    lib = library("byte_bpe_50k.json")
    want = sorted((i, len((t or "").encode()), len(lib.encode(t or "", add_special_tokens=False).ids)) for i, t, *_ in rows)
    found = token_counts.count_tokens(docs).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_tokens) for r in found) == want
    assert all(r.over_limit == (r.n_tokens > 1024) for r in found)
    assert token_counts.count_tokens(empty).count() == 0


def test_token_counts_of_long_texts(monkeypatch):
    lib, draw = library("byte_bpe_50k.json"), random.Random(6)
    counter = token_counts.TokenCounter(public_tokenizers.path("byte_bpe_50k.json"))
    long = ["".join(draw.choice(["word", "it's", " ", "  ", "\n\n ", "é日", "42", "'ll", "...", "<|endoftext|>", "\u3000", "x" * 40]) for _ in range(4000)) for _ in range(3)]
    long.append("y" * 5000)
    want = [len(lib.encode(t, add_special_tokens=False).ids) for t in long]
    for size in (1_000_000, 700, 33):
        monkeypatch.setattr(token_counts, "PART_CHARS", size)
        assert counter.count_block([*long, None, ""]).tolist() == [*want, 0, 0]


def test_packing(docs, unique, rows, empty):
    lib, pieces = library("byte_bpe_50k.json"), collections.defaultdict(list)
    found = packing.pack(unique, size=64, shard_ids=500).collect()
    for r in found:
        pieces[r.doc_id].append(r)
    for i, t, *_ in rows[:-1]:
        ids, at = np.array(lib.encode(t or "", add_special_tokens=False).ids + [1], "<u4"), 0
        for r in sorted(pieces[i], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    windows = collections.defaultdict(list)
    for r in found:
        windows[r.sequence_id].append((r.offset, r.length))
    for parts in windows.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    assert sum(sum(n for _, n in p) < 64 for p in windows.values()) <= int(unique.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    assert packing.pack(empty).count() == 0 and packing.pack(docs).agg({"length": "sum"}).first()[0] > 0


def test_encoder_equals_the_library():
    """Special strings, contractions, letters of every kind, control characters and long words."""
    from corpusmill.llm.tokens import Encoder

    draw = random.Random(3)
    parts = ["it's", "I'LL", " ", "\n", "İ", "ı", "ǅ", "e\u0301", "é", "日本", "½", "²", "42", "<|endoftext|>", "<|startoftext|>", "\x01", "\x02", "\x85", "\xa0", "…", "’s", "ſ", "\u212a", "ß", "Σ", "  ", "\x1c", "Zq", "--", "\x00", "😀", "µ", "€", "\u200b"]
    odd = ["".join(draw.choice(parts) for _ in range(draw.randrange(1, 25))) for _ in range(1500)]
    odd += [f"a{chr(c)}1{chr(c)} {chr(c)}b {chr(c)}{chr(c)}'s{chr(c)}A{chr(c)}" for c in range(0x2600)] + ["z" * 20000, "qj" * 5000, "", texts()[0] * 50]
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        found = Encoder(public_tokenizers.path(name))
        assert found.encode_text != found._library
        want = library(name).encode_batch_fast(odd, add_special_tokens=False)
        assert all(a.tolist() == b.ids for a, b in zip(found.encode_block(odd), want, strict=True))


def test_packing_takes_the_best_neighbour(spark, rows):
    """In one range and one shard every document joined to an open window is the unused one of highest BM25 score."""
    lib = library("byte_bpe_50k.json")
    docs = spark.createDataFrame([r for r in rows[:-1] if r[0] != 900], SCHEMA)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        found = packing.pack(docs, size=1 << 9).orderBy("sequence_id", "offset").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    ids = {i: lib.encode(t, add_special_tokens=False).ids + [1] for i, t, *_ in rows[:-1] if t is not None}
    tails = {i: x[len(x) // 512 * 512 :] for i, x in ids.items()}
    df = collections.Counter(w for x in ids.values() for w in set(x))
    mean, n = sum(map(len, ids.values())) / len(ids), len(ids)
    near = collections.Counter(w for x in tails.values() for w in set(x))

    def bm25(seed, other):
        tf = collections.Counter(tails[other])
        shared = [w for w in set(tails[seed]) & set(tf) if near[w] > 1]
        return sum(np.log1p((n - df[w] + 0.5) / (df[w] + 0.5)) * tf[w] * 2.2 / (tf[w] + 1.2 * (0.25 + 0.75 * len(tails[other]) / mean)) for w in shared)

    unused, seed, judged = {i for i, x in tails.items() if x}, None, 0
    for r in found:
        if r.start < len(ids[r.doc_id]) // 512 * 512:
            continue  # whole windows of long documents
        if r.offset == 0:
            seed = r.doc_id
        elif r.doc_id in unused:
            best = max(bm25(seed, i) for i in unused)
            assert bm25(seed, r.doc_id) >= best - 1e-6
            judged += best > 0
        unused.discard(r.doc_id)
    assert judged >= 10 and not unused


def test_exact_groups(unique, docs, rows, empty):
    found = sorted(map(tuple, exact_dedup.exact_groups(unique, digest_all=True).collect()))
    assert found == duck(rows[:-1], exact_dedup.ORACLE)
    assert exact_dedup.exact_groups(empty).count() == 0
    stay = exact_dedup.drop_copies(unique)
    assert stay.columns == unique.columns and sorted(r.doc_id for r in stay.collect()) == sorted(r[0] for r in found if r[3])
    assert sum(r.kept for r in exact_dedup.exact_groups(docs).collect()) == len({re.sub(r"[ \t-\r]", "", r[1] or "") for r in rows})


def test_line_templates(unique, rows, empty):
    found = sorted(map(tuple, line_templates.drop_templates(unique).collect()))
    assert found == duck(rows[:-1], line_templates.ORACLE)
    assert sum(r[2] for r in found) >= 12
    assert line_templates.drop_templates(empty).count() == 0


def test_long_and_short_lines(spark):
    """A passage of 60 words in three documents goes, one in two stays; a line of one word goes from ten documents on."""
    words = [f"w{'abcdefghij'[k % 10]}{'klmnopqrst'[k // 10]}" for k in range(60)]
    passage, other = " ".join(words), " ".join(reversed(words))
    letters = "abcdefghijklmno"
    rows = [(i, "\n".join(([passage] if i in (1, 5, 9) else []) + ([other] if i in (2, 3) else []) + ["Contents"] * (i < 10) + ["Rare"] * (i < 9) + ["12 34"] + [f"own {letters[i]} text {letters[i] * 3}"])) for i in range(15)]
    rows += [(20, rows[2][1]), (21, rows[2][1]), (22, None), (22, None), (23, "")]  # copies count once
    schema = "doc_id long, text string, lang string, source string, n_chars long, size string, row string"
    found = sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in line_templates.drop_templates(spark.createDataFrame([(*r, None, None, None, None, None) for r in rows], schema).repartition(3)).collect()))
    assert [x[2] for x in found[:15]] == [(i in (1, 5, 9)) + (i < 10) for i in range(15)]
    assert [x[1:] for x in found[15:]] == [(rows[2][1].count("\n") + 1, 1, "\n".join(x for x in rows[2][1].split("\n") if x != "Contents"))] * 2 + [(0, 0, "")] * 3


def test_main_text(spark):
    long = "Sentence with several words &amp; more. " * 6
    page = f"<html><head><title>t</title></head><body><nav>menu</nav><div class='ad'>buy</div><h2>Head&nbsp;line</h2><p>{long}<p>{long}<script>x<y</script><form>sign</form><section id=comments><p>{long}</section><footer>f</footer>"
    want = "Head line " + " ".join([long.replace("&amp;", "&").strip()] * 2)
    assert html_text.main_text(page) == want
    assert html_text.main_text(None) == html_text.main_text("") == ""
    assert html_text.main_text("<article><p>Short<b>er</b>.</article>") == "Shorter."
    pages = spark.createDataFrame([(1, "u", page), (2, None, None), (1, "u", page)], "page_id long, url string, html string")
    assert sorted((r.page_id, r.n_chars) for r in html_text.extract(pages).collect()) == [(1, len(want)), (1, len(want)), (2, 0)]


def test_main_text_keeps_articles():
    """Loose marks drop no article, and a dropped article ends at its own closing tag."""
    story, other, extra = (f"{word} and more words of the page. " * 6 for word in ("story", "other", "extra"))
    text, beside, rest = story.strip(), other.strip(), extra.strip()
    for mark in ("aria-hidden='false'", "class='overflow-hidden'", "style='overflow:hidden'", "title='The hidden city'", "class='post has-sidebar'", "class='no-sidebar'", "class='category-social'", "class='content with-sidebar'"):
        for name in ("div", "article"):
            assert html_text.main_text(f"<body><{name} {mark}><p>{story}</p></{name}></body>") == text, (name, mark)
            # even where most of the page's text is elsewhere
            assert html_text.main_text(f"<body><div {mark}><p>{story}</p></div><div><p>{other}</p><p>{extra}</p></div></body>") == f"{text} {beside} {rest}", mark
    assert html_text.main_text(f"<main class=promo><p>{story}</main>") == text
    assert html_text.main_text(f"<article class=related><p>{story}</p></article><article><p>{other}</p></article>") == f"{text} {beside}"
    for hide in ("hidden", "hidden=''", "aria-hidden=true", "style='display: none'"):
        assert html_text.main_text(f"<div><article {hide}><p>{story}</p></article><article><p>{other}</p></article></div>") == beside, hide
    assert html_text.main_text(f"<article><p>{story}</p><aside><article>inner</article></aside><p>{other}</p></article>") == f"{text} {beside}"
    assert html_text.main_text(f"<div class='page sidebar-layout'><p>{story}</p><p>{other}</p><div class=sidebar-right>{extra}</div></div>") == f"{text} {beside}"
    assert html_text.main_text(f"<div><p>{story}</p><p>{other}</p></div><div class='site-footer'>{extra}</div>") == f"{text} {beside}"


def test_main_text_keeps_what_the_distribution_shows(spark):
    """Link lists inside an article, short paragraphs beside long ones, marked parts that are text."""
    story = "story and more words of the page. " * 6
    text = story.strip()
    links = "".join(f"<li><a href=x>item {i}</a></li>" for i in range(6))
    assert html_text.main_text(f"<article><p>{story}</p><ul>{links}</ul><p>end</p></article>") == f"{text} " + " ".join(f"item {i}" for i in range(6)) + " end"
    assert html_text.main_text(f"<body><div><p>{story}</p><nav>menu</nav><p>Short close.</p></div><div>copyright</div></body>") == f"{text} Short close."
    assert html_text.main_text(f"<div><p>{story}</p><p>{story}</p><section class='related-work'><p>{story}</p></section></div>") == " ".join([text] * 3)
    assert html_text.main_text(f"<div><p>{story}</p><p>{story}</p><div class='related'><ul>{links}</ul></div></div>") == " ".join([text] * 2)
    assert html_text.main_text(f"<div><p>{story}</p><p>{story}</p><div class='comments'><p>{story}</p></div></div>") == " ".join([text] * 2)
    assert html_text.main_text(f"<p>{story}" * 3000) == " ".join([text] * 3000)


def test_main_text_windows_equal_brute_force():
    """Surge and dive over lines without marks: a passage is a run of windows with text, and one of them is above the threshold."""
    draw = random.Random(4)
    for _ in range(200):
        sizes = [draw.choice([0, 0, 0, 0, 5, 40, 90]) for _ in range(draw.randrange(1, 25))]
        page = "".join(f"<div>{'x' * n}</div>" if n else "<div><a>menu</a></div>" for n in sizes)
        runs, i = [], 0
        while i < len(sizes):
            if sum(sizes[i : i + 3]):
                j = i
                while j < len(sizes) and sum(sizes[j : j + 3]):
                    j += 1
                runs.append((i, j))
                i = j
            i += 1
        text = lambda run: ["x" * sizes[k] if sizes[k] else "menu" for k in range(*run)]
        kept = [r for r in runs if max(sum(sizes[k : k + 3]) for k in range(*r)) > html_text.SURGE]
        if not kept and runs:
            kept = [max(runs, key=lambda r: sum(sizes[r[0] : r[1]]))]
        assert html_text.main_text(page) == " ".join(x for r in kept for x in text(r)), sizes


@pytest.mark.parametrize(
    "page",
    ["<b>x" * 40_000 + "</i>" * 40_000, "<a x=\"y\" z='q' " * 30_000, "<div class=ad>x" * 20_000, "<div class=related>x" * 20_000, "<b>" * 30_000 + "<p>x" * 30_000, "<script " * 60_000, "<!x" * 100_000, "<a '" * 50_000 + '<a "' * 50_000, "<div><p>x" * 30_000 + "</div>" * 30_000, "<!--" * 100_000],
)
def test_main_text_of_hostile_pages_is_linear(page):
    import time

    began = time.process_time()
    html_text.main_text(page)
    assert time.process_time() - began < 8


def test_extract_of_odd_rows(spark):
    schema = "page_id long, url string, html string, text string, n_chars int, __html string"
    assert html_text.extract(spark.createDataFrame([], schema)).count() == 0
    rows = spark.createDataFrame([(None, None, "<p>a &amp; b", "x", 1, "y"), (1, "u", "", "x", 1, "y")], schema)
    assert sorted(map(tuple, html_text.extract(rows).collect()), key=str) == [(1, "u", "", 0), (None, None, "a & b", 5)]


def base_statistics(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = collections.Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if line.strip(" \t\n\x0b\x0c\r"):
            repeated += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeated, len(covered)


def test_quality(spark, docs, rows, empty):
    found = quality.judge(docs).collect()
    want = sorted((i, *base_statistics(t or "")) for i, t, *_ in rows)
    assert sorted((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in found) == want
    assert all(r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words) for r in found)
    assert quality.judge(empty).count() == 0
    line = " ".join(WORDS)
    boiler = spark.createDataFrame([(i, f"{line}\nnumber {'abcdefghijklmnop'[i]} alone") for i in range(12)] + [(50, f"{line}\n" + " ".join(f"w{'x' * k}" for k in range(60)))], "doc_id long, text string")
    judged = {r.doc_id: r.kept for r in quality.judge(boiler.selectExpr("*", "'h' AS source")).collect()}
    assert judged[50] and sum(judged.values()) == 1  # documents left with three words are depleted


def test_quality_counts_distinct_documents(spark):
    """Every line that 10 different documents of a host share is boilerplate, however many of them share several lines."""
    alphabet = "abcdefghijklmnopqrst"
    rows, want = [], {}
    for host in range(6):
        for n, shared, own in ((12, 6, 5), (20, 4, 1), (9, 6, 5)):
            name = f"h{host}-{n}"
            lines = [f"menu {alphabet[host]} {alphabet[k]} {alphabet[n - 1]}" for k in range(shared)]
            for i in range(n):
                mine = [f"own {alphabet[host]} {alphabet[i]} {alphabet[k]} {alphabet[n - 1]}" for k in range(own)]
                want[len(rows)] = 4 * shared if n >= 10 else 0
                rows.append((len(rows), "\n".join(lines + mine), name))
    for k in range(12):  # copies, up to case, digits and white space, are one document
        want[len(rows)] = 0
        rows.append((len(rows), f"Page  {k % 10} of\n\nthe one text" if k % 2 else f"page {k % 10} of\nTHE one text", "copies"))
    judged = quality.judge(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)).collect()
    assert {r.doc_id: r.n_line_words for r in judged} == want


def test_binary_round_trip(spark, docs, rows, empty):
    lib = library("word_bpe_49k.json")
    for name, plane_bits in (("bits", 1), ("bytes", 8)):
        path = binary_ids.id_files_path(spark, name)
        binary_ids.write_ids(docs, path, plane_bits=plane_bits)
        found, at = sorted(binary_ids.read_ids(spark, path, keep_ids=True).collect(), key=lambda r: r.start), 0
        assert [r.doc_id for r in found] == sorted(r[0] for r in rows)
        by_id = {r[0]: r[1] for r in rows}
        for r in found:
            ids = np.array(lib.encode(by_id[r.doc_id] or "", add_special_tokens=False).ids + [1], "<u4")
            assert (r.start, r.n_tokens, r.ids_crc32, bytes(r.ids)) == (at, len(ids), zlib.crc32(ids.tobytes()), ids.tobytes())
            at += len(ids)
    ids = np.arange(100_000, dtype="<u4") * 7 % 49_000
    for plane_bits in (1, 8):
        image = binary_ids.write_shard(ids, [1, None], [99_000, 1_000], plane_bits)
        for start, stop in ((0, 1), (32_767, 32_769), (50_000, 99_999), (99_999, 200_000), (5, 5)):
            assert np.array_equal(binary_ids.read_range(image, start, stop), ids[start:stop])
        assert binary_ids.read_shard(image)[1] == [1, None]
    path = binary_ids.id_files_path(spark, "none")
    binary_ids.write_ids(empty, path)
    assert binary_ids.read_ids(spark, path).count() == 0


def test_sql_bpe(docs, rows, empty):
    import tiktoken

    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    lib = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = sorted((i, hashlib.sha256(np.array(lib.encode_ordinary(t or ""), "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()) for i, t, *_ in rows)
    found = bpe_sql.encode_and_decode(docs).collect()
    assert sorted((r.doc_id, r.ids_sha256, r.decoded_sha256) for r in found) == want
    assert bpe_sql.encode_and_decode(empty).count() == 0


def test_sql_bpe_of_long_words():
    """Words of up to 100,000 bytes, and short alphabets where a merged token's pair ranks lower than its own."""
    import tiktoken

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    lib = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    bpe, draw = bpe_sql.SqlBpe(path, public_tokenizers.PATTERN), random.Random(2)
    words = ["z" * 100_000, base64.b64encode(draw.randbytes(75_000)).decode(), "ab" * 3000, "".join(draw.choice(WORDS) for _ in range(4000)), "日本語" * 3000]
    for _ in range(60):
        few = "".join(draw.choice("etaoinsrhld-=.aAbc01é日") for _ in range(draw.choice([2, 3, 5, 8])))
        words.append("".join(draw.choice(few) for _ in range(draw.randrange(200, 1500))))
    ids = bpe.encode_block(words)
    assert all(a.tolist() == lib.encode_ordinary(w) for a, w in zip(ids, words, strict=True))
    assert bpe.decode_block(ids) == [w.encode() for w in words]


def test_sql_bpe_by_pieces(monkeypatch):
    """Ids are the library's whatever stands at the cuts of chunks and pieces; decoding follows positions."""
    import tiktoken

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    bpe, draw = bpe_sql.SqlBpe(path, public_tokenizers.PATTERN), random.Random(12)
    lib = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks, special_tokens={})
    parts = ["a", "b ", " ", "  ", "\n", "\t", "\xa0", "\u3000", "\u2003", "\x1c", "\x85", "\0", "é", "¿", "日", "’", "'s", "<|endoftext|>", "12", " <", "½", ".", "zqj", "ththe", " queesastado"]
    odd = [None, "", " ", "  ", *texts()] + ["".join(draw.choice(parts) for _ in range(draw.randrange(1, 14))) for _ in range(3000)]
    for batch, together in ((odd, 4_000_000), (odd, 100), (pa.array(["skip", *odd], pa.string()).slice(1), 1000), ([None, ""], 1), ([], 1)):
        monkeypatch.setattr(bpe_sql, "WORD_BYTES", together)
        ids = bpe.encode_block(batch)
        plain = batch if isinstance(batch, list) else batch.to_pylist()
        assert [x.tolist() for x in ids] == [lib.encode_ordinary(t or "") for t in plain]
        assert bpe.decode_block(ids) == [(t or "").encode() for t in plain]
    order = list(range(len(ids := lib.encode_ordinary(text := "an ordered aggregation, " * 500))))
    draw.shuffle(order)
    bpe._register("ids", {"doc": [0] * len(ids), "pos": order, "tok": [ids[i] for i in order]})
    assert bpe.db.execute(bpe_sql.DECODE).fetchall() == [(0, text)]


def test_sql_bpe_contracts_a_piece_once(monkeypatch):
    """No token stands across the parts of these words, so they are not contracted again for each word."""
    bpe, draw = bpe_sql.SqlBpe(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN), random.Random(13)
    made, merged = [], bpe._merged
    monkeypatch.setattr(bpe, "_merged", lambda words, query: made.extend(words) or merged(words, query))
    bpe.encode_block([" " + "".join(draw.choice(["xqz", "zqj", "jqx", "qjz"]) for _ in range(8)) for _ in range(2000)])
    assert len(made) == len(set(made)) and sum(map(len, made)) < 5000


def test_leaves_are_exact_and_bounded(spark):
    """A line's tokens are counted once; its leaf is its number of tokens and its leading tokens, as a digest where they are long."""
    lines = ["a", "a b", "a b c", "a b d", "a bc", "ab c", "a <*> c", "é" * 16, "é" * 17, "x" * 32, "x" * 33, "#" + hashlib.md5(b"x" * 33).hexdigest(), "x" * 5000 + " y", "x" * 5000 + " z", "2 b"]
    found = spark.createDataFrame([("\n".join([*lines, "", lines[0]]),)], "text string").select(line_templates._in_leaves(F.col("text"), 2).alias("x")).first().x
    masked = [" ".join("<*>" if re.search("[0-9]", t) else t for t in line.split(" ")) for line in lines]
    assert [(r.text, r.n) for r in found] == [(m, len(m.split(" "))) for m in masked]
    keys = [(len(m.split(" ")), *m.split(" ")[:2]) for m in masked]
    assert all((r.leaf == q.leaf) == (a == b) for r, a in zip(found, keys, strict=True) for q, b in zip(found, keys, strict=True))
    assert max(len(r.leaf.encode()) for r in found) <= 2 + 33
    size = F.col("n")
    constant = spark.createDataFrame([(m, len(m.split(" "))) for m in masked], "m string, n int").select("m", line_templates._constant_tokens(F.col("m"), size).alias("c")).collect()
    assert [r.c for r in constant] == [sum(t != "<*>" for t in m.split(" ")) for m in masked]


def test_chunks_of_texts_are_encoded_once(monkeypatch):
    """Ids by distinct chunks are those of whole texts, whatever white space, special string or bound stands at a cut."""
    bpe = tokens.encoder(public_tokenizers.path("byte_bpe_50k.json"))
    draw = random.Random(11)
    parts = ["a", "b ", " ", "  ", "\n", "\t", "\xa0", "\u3000", "\u2003", "\x1c", "\x85", "é", "¿", "日", "’", "'s", *bpe.special, "1", " <", "½", "."]
    odd = [None, "", " ", "  ", *texts()] + ["".join(draw.choice(parts) for _ in range(draw.randrange(1, 14))) for _ in range(3000)]
    for batch in (pa.array(["skip", *odd], pa.string()).slice(1), pa.array([None, ""], pa.string()), pa.array([], pa.string())):
        ids, bounds = bpe.encode_array(batch, 1)
        assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)] == [[*x.tolist(), 1] for x in bpe.encode_block(batch.to_pylist())]
    seen, plain = [], bpe.encode_text
    monkeypatch.setattr(bpe, "encode_text", lambda text: seen.append(text) or plain(text))
    bpe.encode_array(pa.array(["the same words again and again"] * 500), 1)
    assert sum(map(len, seen)) <= len("the same words again and again")


def test_words_of_texts_are_encoded_once(monkeypatch):
    """Ids by distinct words are the library's, whatever white space, special string, letter or bound stands around them."""
    bpe, lib, draw = tokens.encoder(public_tokenizers.path("word_bpe_49k.json")), library("word_bpe_49k.json"), random.Random(14)
    parts = ["a", "B ", " ", "  ", "\n", "\t", "\x0b", "\xa0", "\u3000", "\x1c", "\x85", "\0", "\x01", "\x02", "É", "e\u0301", "\u0301", "İ", "Σ", "ΑΣ ", "ſ", "¿", "日", "’", "'s", "'", "LL", *bpe.special, "<|", "endoftext|>", "12", "½", "!!", "Å"]
    odd = [None, "", " ", "  ", *texts()] + ["".join(draw.choice(parts) for _ in range(draw.randrange(1, 14))) for _ in range(3000)]
    for batch in (pa.array(["skip", *odd], pa.string()).slice(1), pa.array([None, "", " "], pa.string()), pa.array([], pa.string())):
        ids, bounds = bpe.encode_array(batch, 1)
        assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)] == [[*lib.encode(t or "", add_special_tokens=False).ids, 1] for t in batch.to_pylist()]
    seen, plain = [], bpe.pieces
    monkeypatch.setattr(bpe, "pieces", lambda text: seen.append(text) or plain(text))
    bpe.encode_array(pa.array(["the same words again and again"] * 500), 1)
    assert sum(map(len, seen)) <= len("the same words again and again")


def test_lattice_scores(docs, rows, empty):
    found = {r.doc_id: r for r in lattice_lm.score(docs, steps=2).collect()}
    tokens = [(i, re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + [None]) for i, t, *_ in rows]
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 1
    counts = collections.Counter(w for i, ws in tokens if not held(i) for w in ws)
    n, v = sum(counts.values()), len(counts)
    for i, ws in tokens:
        base = sum(np.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws)
        r = found[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(i), len(ws), sum(counts[w] > 0 for w in ws), n)
        assert abs(r.base_score - base) < 1e-6 * max(1, abs(base)) and r.score < 0
    assert lattice_lm.score(empty).count() == 0


def test_lattice_counts_the_ends_of_long_texts(spark):
    """The end is rarer than any frequent word here, and known all the same."""
    rows = [(i, " ".join(["word"] * 70_000)) for i in (0, 2, 3, 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    held = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 5 == 1]
    trained = len(rows) - len(held)
    n = trained * 70_001
    for r in lattice_lm.score(docs, steps=1).collect():
        want = 70_000 * np.log10((trained * 70_000 + 0.5) / (n + 1.5)) + np.log10((trained + 0.5) / (n + 1.5))
        assert r.n_known == 70_001 and r.train_tokens == n and abs(r.base_score - want) < 1e-6 * abs(want)


def test_lattice_scores_equal_brute_force(spark, unique, rows):
    """The whole model against sums over all segmentations, with the trained probabilities; steps raise the likelihood."""
    vocab = "piece_bpe_32k.model"
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1
    words = [(i, re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))) for i, t, *_ in rows[:-1]]
    counts = collections.Counter(w for i, ws in words if not held(i) for w in ws)
    counts[lattice_lm.END] = sum(not held(i) for i, _ in words)
    table = spark.createDataFrame(list(counts.items()), "word string, c long")
    logs, end = lattice_lm.piece_probabilities(table, vocab, 3, 0.0)
    pieces = dict(zip(lattice_lm.lattice(public_tokenizers.path(vocab)).pieces, np.exp(logs), strict=True))
    assert abs(sum(pieces.values()) + np.exp(end) - 1) < 1e-9

    def probability(word):
        raw = b" " + word.encode()
        alpha = [1.0] + [0.0] * len(raw)
        for j in range(1, len(raw) + 1):
            alpha[j] = sum(alpha[i] * pieces[raw[i:j]] for i in range(max(0, j - 64), j) if raw[i:j] in pieces)
        return np.log10(alpha[-1])

    found = {r.doc_id: r.score for r in lattice_lm.score(unique, steps=3, tolerance=0.0).collect()}
    for i, ws in words:
        if all(len(w) < 40 for w in ws):
            want = sum(map(probability, ws)) + end / np.log(10)
            assert abs(found[i] - want) < 1e-6 * max(1, abs(want))


def test_lattice_sums_all_segmentations():
    lattice = lattice_lm.lattice(public_tokenizers.path("piece_bpe_32k.model"))
    logs = dict(zip(lattice.pieces, lattice.first, strict=True))

    def brute(raw, at=0):
        return 1.0 if at == len(raw) else sum(np.exp(logs[raw[at:j]]) * brute(raw, j) for j in range(at + 1, len(raw) + 1) if raw[at:j] in logs)

    words = [b"the", b"nation", "é".encode(), b"\xff"]
    assert np.allclose(lattice.score(words, lattice.weights(lattice.first)), [np.log(brute(b" " + w)) for w in words])


def test_lattice_words_equal_the_pattern():
    """Words come from Arrow a block at a time, as the pattern and lower-casing of A-Z give them."""
    texts = [None, "", " \t\n", "a", " A\x0bb\x0cC\r\nd\te\x1cf\x85G\xa0h ", "ÀZ İ \x00 \u3000Z  a", *texts_of_words()]
    for batch in (pa.array(texts, pa.string()), pa.array(["x", *texts], pa.string()).slice(1), pa.array([None, " "], pa.string()), pa.array([], pa.string())):
        owner, codes, words = lattice_lm.lowered_words(batch)
        found = [[] for _ in batch]
        for i, code in zip(owner.tolist(), codes.tolist(), strict=True):
            found[i].append(words[code].as_py())
        want = [re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) for t in batch.to_pylist()]
        assert found == want and len(set(words.to_pylist())) == len(words)


def texts_of_words():
    return [t for t in texts() if len(t) < 2000]


def test_lattice_sums_agree_with_logarithms(monkeypatch):
    """Plain probabilities, which spare a logarithm an arc, give what sums of logarithms give; long words don't underflow."""
    lattice = lattice_lm.lattice(public_tokenizers.path("piece_bpe_32k.model"))
    weights = lattice.weights(lattice.first)
    words = [b"x" * 400, *(w.encode() for t in texts_of_words() for w in t.lower().split())]
    counts = np.arange(1, len(words) + 1)
    plain, (uses, likelihood) = lattice.score(words, weights), lattice.expect(words, counts, weights)
    monkeypatch.setattr(lattice_lm, "LEAST", 0.0)
    again, (uses_again, likelihood_again) = lattice.score(words, weights), lattice.expect(words, counts, weights)
    assert np.isfinite(plain).all() and np.allclose(plain, again, rtol=1e-10) and np.allclose(uses, uses_again, rtol=1e-8)
    assert abs(likelihood - likelihood_again) < 1e-9 * abs(likelihood)


def test_lattice_scores_words_of_held_out_documents(spark):
    """A word that only held-out documents have is scored once, unknown to the base; frequent and rare words alike."""
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 1
    rows = [(i, "unseen Unseen word" if held(i) else "word other") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in lattice_lm.score(docs, steps=1).collect()}
    frequent, lattice_lm.FREQUENT = lattice_lm.FREQUENT, 1
    try:
        rare = {r.doc_id: r for r in lattice_lm.score(docs, steps=1).collect()}
    finally:
        lattice_lm.FREQUENT = frequent
    for i, r in found.items():
        assert r.held_out == held(i) and r.n_known == (2 if held(i) else 3)
        assert tuple(r)[:5] == tuple(rare[i])[:5] and abs(r.base_score - rare[i].base_score) < 1e-9 and abs(r.score - rare[i].score) < 1e-9


def test_near_classes(unique, rows, empty):
    found = sorted(map(tuple, near_dup.near_classes(unique).collect()))
    assert found == duck(rows[:-1], near_dup.ORACLE)
    assert sum(r[0] != r[1] for r in found) >= 5
    assert near_dup.near_classes(empty).count() == 0


def test_near_classes_among_texts_that_share_passages(spark):
    """2,000 pairs of similarity 0.8 among texts that share over half of their shingles: none is lost."""
    common = " ".join(f"c{k}" for k in range(213))
    rows = []
    for i in range(2000):
        own = [f"o{i}x{k}" for k in range(87)]
        rows += [(2 * i, " ".join([common, *own])), (2 * i + 1, " ".join([common, *own[:55], *(f"p{i}x{k}" for k in range(32))]))]
    found = {r.doc_id: (r.class_id, r.n_links) for r in near_dup.near_classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    lost = [i for i, _ in rows if found[i] != (i - i % 2, 1)]
    assert not lost


def test_link_block_equals_brute_force():
    draw = np.random.Generator(np.random.PCG64(5))
    for n, pool in ((1, 10), (40, 30), (150, 400)):
        base = [np.unique(draw.integers(0, pool, draw.integers(1, 60)).astype(np.uint64)) for _ in range(n)]
        sets = base + [np.unique(np.append(s[1:], np.uint64(9999))) for s in base]
        copies = draw.integers(1, 4, len(sets))
        shared = np.array([[len(np.intersect1d(a, b)) for b in sets] for a in sets])
        sizes = np.array(list(map(len, sets)))
        linked = shared >= 0.6 * (sizes[:, None] + sizes - shared) - 1e-9
        np.fill_diagonal(linked, False)
        assert (near_dup.shared_counts(sets) - np.diag(np.diag(near_dup.shared_counts(sets))) == shared - np.diag(np.diag(shared))).all()
        links, roots = near_dup.link_block(copies, sets, 0.6)
        assert (links == linked @ copies).all() and all(roots[i] == roots[j] for i, j in np.argwhere(linked))
        assert len(set(roots)) == len({tuple(np.flatnonzero(r)) for r in np.linalg.matrix_power(linked.astype(float) + np.eye(len(sets)), 2 * len(sets) if len(sets) < 40 else 64) > 0})
        links, _ = near_dup.link_block(copies, sets, 0.6, n)
        assert (links == np.concatenate([linked[:n, n:] @ copies[n:], copies[:n] @ linked[:n, n:]])).all()


def test_near_copies_go_by_row(spark):
    """Rows of one id with different texts are told apart; clashing names and repeated rows do no harm."""
    a, b = " ".join(WORDS), " ".join(reversed(WORDS))
    rows = [(1, a, 7), (2, a + " tail", 8), (2, b, 9), (3, None, 1), (3, "", 1), (4, b, 2), (4, b, 2), (None, "x y", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, bitmap_bucket int").withColumnRenamed("bitmap_bucket", "bitmap").withColumn("__c0", F.lit(1)).withColumn("bitmap_bucket", F.lit(2))
    left = near_dup.drop_near_copies(docs)
    assert left.columns == docs.columns
    assert sorted(((r.doc_id or 0), r.text or "") for r in left.collect()) == sorted([(1, a), (2, b), (3, ""), (3, ""), (0, "x y")])
    same = spark.createDataFrame([(1, a), (1, a), (5, a)], "doc_id long, text string")
    assert [r.doc_id for r in near_dup.drop_near_copies(same).collect()] == [1]
    assert near_dup.drop_near_copies(docs.where("false")).count() == 0


def test_near_classes_of_many_variants(spark):
    """One template, 1,500 variants: classes and links equal brute force over all pairs."""
    draw = random.Random(11)
    base = [f"w{k}" for k in range(60)]
    rows = []
    for i in range(1500):
        words = list(base)
        for _ in range(draw.randrange(4)):
            words[draw.randrange(60)] = f"v{draw.randrange(40)}"
        rows.append((i, " ".join(words)))
    sets = [np.unique([hash(tuple(t.split()[k : k + 5])) for k in range(56)]).astype(np.int64).astype(np.uint64) for _, t in rows]
    texts_seen = {}
    for i, t in rows:
        texts_seen.setdefault(t, []).append(i)
    keys = sorted(texts_seen)
    links, roots = near_dup.link_block(np.array([len(texts_seen[t]) for t in keys]), [sets[texts_seen[t][0]] for t in keys], 0.8)
    least = {}
    for t, r in zip(keys, roots, strict=True):
        least[r] = min(least.get(r, 1 << 60), min(texts_seen[t]))
    want = sorted((i, least[roots[k]], int(links[k]) + len(texts_seen[t]) - 1) for k, t in enumerate(keys) for i in texts_seen[t])
    found = near_dup.near_classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert sorted(map(tuple, found)) == want


def test_pipeline(spark, rows, empty, tmp_path):
    """Against SQL for the rules and the near copies, and plain Python for the exact ones; some documents are all boilerplate."""
    letters = "abcdefghijklmnop"
    shared = " ".join(WORDS) + " and some more words of a frequent notice"
    boiler = [(2000 + i, f"{shared}\nonly {letters[i] * 3} here", "en", "boiler", 100, None, None) for i in range(12)]
    fine = [(2100, f"{shared}\n" + " ".join(f"{w}{c}" for w in ("own", "mine") for c in letters), "en", "boiler", 100, None, None)]
    every = rows[:-1] + boiler + fine
    spark.createDataFrame(every, SCHEMA).select("doc_id", "text", "lang", "source", "n_chars").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    packed = {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    kept = {r[0] for r in duck(every, f"SELECT doc_id, kept FROM ({quality.ORACLE})") if r[1]}
    assert 2100 in kept and not kept & {r[0] for r in boiler}
    groups = collections.defaultdict(list)
    for i, t, *_ in every:
        if i in kept:
            groups[re.sub(r"[ \t-\r]", "", t)].append((-len(t), i, t))
    clean = sorted((i, t) for g in groups.values() for _, i, t in [min(g)])
    classes = dict(r[:2] for r in duck([(i, t, None, None, None) for i, t in clean], near_dup.ORACLE))
    assert packed == {i for i, _ in clean if classes[i] == i}
    empty.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{tmp_path}/none/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0


def test_drop_stages_with_clashing_columns(spark):
    """Helper names of any kind in the caller's table, and empty tables."""
    schema = "doc_id long, text string, source string, bitmap int, bitmap_bucket int, __open int, __key int, __row int, __c0 int, key int, row int, stays int, open int"
    text = " ".join(WORDS) + " " + " ".join(reversed(WORDS))
    docs = spark.createDataFrame([(1, text, "h", *[7] * 10), (2, text, "h", *[8] * 10), (3, None, None, *[None] * 10)], schema)
    for drop, left in ((quality.drop_rejected, [1, 2]), (exact_dedup.drop_copies, [1, 3]), (near_dup.drop_near_copies, [1, 3])):
        found = drop(docs)
        assert found.columns == docs.columns and sorted(r.doc_id for r in found.collect()) == left, drop
        assert drop(docs.where("false")).count() == 0


def test_quality_equals_its_statement(spark, unique, rows):
    found = quality.judge(unique)
    names = sorted(found.columns)
    want = duck(rows[:-1], f"SELECT {', '.join(names)} FROM ({quality.ORACLE})")
    assert sorted(tuple(r[c] for c in names) for r in found.collect()) == want
