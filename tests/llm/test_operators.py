"""Every operator on a small table with nulls, empty texts, repeated rows and clashing columns, against brute force."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sixfold.llm import decontaminate, html, language, lines, mixing, quality, repeats, toxicity, urls
from sixfold.llm.textscan import Texts

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, size int, node string, __copy int"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    words = [f"wort{i}" for i in range(60)] + ["über", "ñandú", "A", "The"]
    line = lambda n: " ".join(rng.choice(words) for _ in range(n))
    common = [line(12) for _ in range(5)]
    out = []
    for i in range(60):
        text = "\n".join(rng.choice(common) if rng.random() < 0.3 else line(rng.randint(1, 25)) for _ in range(rng.randint(1, 8)))
        out.append((i * 7 % 61, text, rng.choice(["en", "de", None]), rng.choice(["a", "b", "c", "d", None]), len(text), 1, "x", 2))
    out += [(100, None, None, None, None, 1, "x", 2), (101, "", "en", "a", 0, 1, "x", 2), (102, " \n\t", "en", "b", 3, 1, "x", 2), out[0], out[0], (103, "\n".join(common) * 40, "de", "a", 9, 1, "x", 2)]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def labels(spark, rows):
    return spark.createDataFrame([(r[0], 1, int("wort1 " in (r[1] or ""))) for r in rows[:50]] + [(None, 1, 1), (999, 0, 0)], "doc_id bigint, quality int, toxic int")


def key(line):
    line = line.strip(" \t\n\x0b\x0c\r")
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line)


def test_lines(docs, rows):
    holders = {}
    for r in rows:
        for x in (r[1] or "").split("\n"):
            holders.setdefault(key(x), set()).add(r[0])
    expected = []
    for r in rows:
        left = [x for x in (r[1] or "").split("\n") if len(key(x)) < 10 or min(holders[key(x)]) == r[0]]
        expected.append((r[0], "\n".join(left)))
    got = lines.drop_shared_lines(docs)
    assert got.columns == [*docs.columns, "__n_lines", "__n_dropped"]
    assert sorted((r.doc_id, r.text or "") for r in got.collect()) == sorted(expected)


def test_repeats(docs, rows):
    seen, expected = set(), {}
    for doc, text in sorted({(r[0], r[1] or "") for r in rows}):
        raw = text.encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - 99):
            if raw[i : i + 100] in seen:
                gone[i : i + 100] = b"\1" * 100
            seen.add(raw[i : i + 100])
        expected[doc] = (sum(gone), bytes(x for x, g in zip(raw, gone) if not g))
    got = repeats.remove_repeats(docs.select("doc_id", "text")).collect()
    assert len(got) == len(rows) and all((r.n_removed, bytes(r.kept)) == expected[r.doc_id] for r in got)


def test_decontaminate(spark, docs, rows):
    items = [(1, "Wort1 wort2 über"), (2, "  "), (3, None), (4, rows[3][1]), (5, rows[3][1]), (None, rows[5][1])]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    import re

    word = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", key(t or "") if t else "")
    windows = [(i, tuple(w[k : k + min(10, len(w))])) for i, t in items for w in [word(t)] if w for k in range(len(w) - min(10, len(w)) + 1)]
    for part in (decontaminate.find_items(docs, bench), decontaminate.find_items(docs, bench, max_tokens=20)):
        for r in part.collect():
            w, hit, names = word(r.text), set(), set()
            for i, win in windows:
                for k in range(len(w) - len(win) + 1):
                    if tuple(w[k : k + len(win)]) == win:
                        hit |= set(range(k, k + len(win)))
                        names |= {str(i)} if i is not None else set()
            assert r["__n_words"] == len(w) and {p for a, b in r["__spans"] for p in range(a, b)} == hit and r["__items"] == sorted(names)
    cleaned = decontaminate.remove_items(docs, bench)
    assert cleaned.columns == docs.columns
    assert not [r for r in decontaminate.find_items(cleaned, bench, 10).collect() if "4" in r["__items"]]


def test_mixing(docs, rows):
    sizes = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + len((r[1] or "").split())
    order = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    total, fixed = sum(sizes.values()), set()
    while True:
        rest = total - sum(3 * sizes[s] for s in fixed)
        free = [s for s in order if s not in fixed]
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        above = {s for s in free if share[s] > 3 * sizes[s]}
        if not above:
            break
        fixed |= above
    target = {s: share.get(s, 3 * sizes[s]) for s in order}
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows) and sorted(map(tuple, got), key=str) == sorted(map(tuple, mixing.mix(docs.repartition(7)).collect()), key=str)
    for s in order:
        mine = [r for r in got if r.source == s]
        assert all(math.isclose(r.target, target[s]) and r.source_size == sizes[s] and r.taken <= 3 * r.size for r in mine)
        assert abs(sum(r.taken for r in mine) - target[s]) <= max(r.size for r in mine)


def test_mixed_keeps_repeated_rows(docs, rows):
    again = docs.union(docs.where("doc_id % 5 = 0 OR doc_id IS NULL")).union(docs.where("doc_id = 14").withColumn("source", F.lit("e")))
    given = [r for r in mixing.mix(again).collect() if r.repeats > 0]
    got = mixing.mixed(again)
    assert got.columns == [*docs.columns, "repeats", "taken"]
    brief = lambda found: sorted(((r.doc_id, r.source, r.repeats, r.taken) for r in found), key=str)
    assert brief(got.collect()) == brief(given) and len(given) > len({(r.doc_id, r.row) for r in given})


def test_quality(docs, labels, rows):
    for r in quality.apply_rules(docs, labels).collect():
        text = next(x[1] for x in rows if x[0] == r.doc_id) or ""
        w = text.split()
        grams = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
        twice = {k + j for k, g in enumerate(grams) if grams.count(g) > 1 for j in range(3)} if len(w) < 400 else None
        full = [x for x in text.split("\n") if x.strip()]
        assert (r.n_words, r.word_chars, r.n_dup_lines) == (len(w), sum(map(len, w)), len(full) - len(set(full)))
        assert twice is None or r.n_repeat_words == len(twice)
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) and not (r.base_failed and r.kept)


def test_binomial_bound():
    for k, n, p in ((0, 10, 0.1), (3, 200, 0.05), (7, 50, 0.3)):
        exact = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
        assert math.isclose(quality.binomial_tail(k, n, p), exact, rel_tol=1e-9)
    assert quality.choose_level([0, 0, 1, 40], 1000, 0.03, 0.05) == 2 and quality.choose_level([0, 0], 20, 0.03, 0.05) == -1


def test_toxicity_and_language(docs, labels):
    scored = toxicity.score_toxicity(docs, toxicity.label_columns(labels), toxicity.CATEGORIES)
    got = {r.doc_id: r.p_toxic for r in scored.collect()}
    assert all(0 <= p <= 1 for p in got.values()) and got[100] == got[101] == got[102] == 0
    found = language.predict_language(docs.select("doc_id", "text"), docs).collect()
    assert {r.lang_pred for r in found if r.doc_id in (100, 101, 102)} == {"und"} and all(0 <= r.score <= 1 for r in found)


def test_forward_algorithm_sums_all_segmentations():
    voc = language.vocabulary(language.VOCABULARY)
    p = np.random.default_rng(1).random((voc.size, 1)) / voc.size
    word = b"there"
    marked = b" " + word
    by_hash = {int(h): int(n) for h, n in zip(voc.hashes, voc.order)}
    from sixfold.llm.textscan import VALUES, span_hash, sums

    def total(i):
        if i == len(marked):
            return 1.0
        out = 0.0
        for j in range(i + 1, min(len(marked), i + language.LONGEST) + 1):
            raw = np.frombuffer(marked[i:j], np.uint8)
            n = by_hash.get(int(span_hash(sums(raw, VALUES), np.array([0]), np.array([len(raw)]))[0]))
            out += p[n, 0] * total(j) if n is not None else 0
        return out

    assert math.isclose(language.log_likelihood(voc, [word], p)[0, 0], math.log(total(0)), rel_tol=1e-9)


def test_long_pieces_and_runs_against_the_unrestricted_sum():
    import pyarrow as pa
    import sentencepiece

    voc = language.vocabulary(language.VOCABULARY)
    model = sentencepiece.SentencePieceProcessor(model_file=language.VOCABULARY)
    known = {bytes([b]) for b in range(256)}
    for i in range(model.vocab_size()):
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)):
            known.add(bytes(c + 32 if 65 <= c <= 90 else c for c in model.id_to_piece(i).replace("▁", " ").encode()))
    number = {piece: k for k, piece in enumerate(sorted(known))}
    assert voc.size == len(number) and " international".encode() in number
    p = np.random.default_rng(3).random((voc.size, 2)) / voc.size
    longest = max(map(len, number))

    def forward(word):  # log sums, so that nothing underflows
        marked = b" " + word
        log = [np.zeros(2)] + [np.full(2, -np.inf) for _ in marked]
        for i in range(len(marked)):
            for j in range(i + 1, min(len(marked), i + longest) + 1):
                if marked[i:j] in number:
                    log[j] = np.logaddexp(log[j], log[i] + np.log(p[number[marked[i:j]]]))
        return log

    texts = ["international", "département", "donaudampfschifffahrtsgesellschaftskapitän", "распределение", "这是一个没有空格的很长的句子用来测试语言识别的算法" * 60, "a"]
    words = [t.encode() for t in texts]
    got = language.log_likelihood(voc, words, p)
    assert np.allclose(got, [forward(w)[-1] for w in words], rtol=1e-9)

    runs = Texts(pa.array([texts[2] + " " + texts[4]]))
    found, h = language.letter_runs(runs)
    assert language.spelled(runs, found, np.arange(len(h))) == [words[2], words[4]]  # nothing is cut

    q, expected = p[:, 0] / p[:, 0].sum(), np.zeros(voc.size)
    p[:, 0] = q
    for w, times in zip(words, range(1, 7)):
        marked, before = b" " + w, [x[0] for x in forward(w)]
        after = [-np.inf] * len(marked) + [0.0]
        for i in reversed(range(len(marked))):
            for j in range(i + 1, min(len(marked), i + longest) + 1):
                if marked[i:j] in number:
                    after[i] = np.logaddexp(after[i], np.log(q[number[marked[i:j]]]) + after[j])
        for i in range(len(marked)):
            for j in range(i + 1, min(len(marked), i + longest) + 1):
                if (n := number.get(marked[i:j])) is not None:
                    expected[n] += times * math.exp(before[i] + math.log(q[n]) + after[j] - after[0])
    assert np.allclose(language.expected_counts(voc, words, np.arange(1, 7), q), expected, rtol=1e-9, atol=1e-12)


def test_html(spark):
    page = "<body><nav><a href=x>menu</a></nav><article><h1>T &amp; U</h1><p><b>one<br>two\n three<p>four words of prose here, and more.</article><footer>end</footer>"
    pages = spark.createDataFrame([(k, "u", page.replace("four", f"four{k}")) for k in range(30)] + [(90, None, None), (91, "u", "")], "page_id bigint, url string, html string")
    got = {r.page_id: (r.text, r.n_chars) for r in html.extract_text(pages).collect()}
    assert got[90] == got[91] == ("", 0)
    assert got[3][0] == "T & U\n\none two three\n\nfour3 words of prose here, and more."


def test_html_open_heads_and_math(spark):
    body = "<article><h1>Title</h1><p>some words of prose <math><mi>x</mi> <mo>=</mo> <mn>2</mn></math> here, and more.</article>"
    opened = "<!doctype html><html><head><meta charset=utf-8><title>gone</title><style>p {}</style><template><p>gone</p></template>\n"
    heads = [opened + "</head><body>", opened + "<body>", opened, opened + "<!-- --><script>gone()</script>", "<body><head>", opened + "<p>"]
    whole = "Title\n\nsome words of prose x = 2 here, and more."
    texts = lambda rows: {r.page_id: r.text for r in html.extract_text(spark.createDataFrame(rows, "page_id int, html string")).collect()}
    assert texts([(k, head + body) for k, head in enumerate(heads)]) == dict.fromkeys(range(len(heads)), whole)
    untrained = body.replace("article", "div")
    assert texts([(0, opened + untrained), (1, opened + "plain text <b>here</b>"), (2, opened + "<title>t</title>")]) == {0: whole, 1: "plain text here", 2: ""}
    assert any(n.tag == "article" for n in html.describe(html.parse(opened + body))[0])


def test_urls(spark):
    captures = spark.createDataFrame([(1, "http://a.b.com/x/1", "2024-03-01"), (2, "http://a.b.com/", "2024-01-01"), (3, None, "2024-03-01"), (4, "nonsense", None), (1, "http://a.b.com/x/1", "2024-03-01")], "page_id int, url string, fetched string").withColumn("fetched", F.to_timestamp("fetched"))
    entries = spark.createDataFrame([("b.com", "2024-02-01", "block"), ("b.com", "2024-04-01", "remove"), ("a.b.com/x", "2024-05-01", "allow"), (None, "2024-01-01", "block")], "key string, since string, action string").withColumn("since", F.to_timestamp("since"))
    got = sorted((r.page_id, r.blocked, r.listed_key) for r in urls.listed_at_fetch(captures, entries, ["page_id"]).collect())
    assert got == [(1, True, "b.com"), (1, True, "b.com"), (2, False, None), (3, False, None), (4, False, None)]


def test_entries_of_any_path(spark):
    url = "http://User@B.com/x/1/y.html?q=1#top"
    listed = ["b.com/x/1/y.html?q=1", "b.com/x/1/y.html", "b.com/x/1", "b.com/x", "b.com"]
    assert spark.createDataFrame([(url,)], "url string").select(urls.url_keys(F.col("url"))).first()[0] == listed
    captures = spark.createDataFrame([(url, "2024-03-01"), ("http://b.com/x/1", "2024-03-01"), ("http://b.com/x1", "2024-03-01")], "url string, fetched string").withColumn("fetched", F.to_timestamp("fetched"))
    for key in listed[:-1]:
        entries = spark.createDataFrame([(key, "2024-01-01", "block")], "key string, since string, action string").withColumn("since", F.to_timestamp("since"))
        got = {r.url: r.listed_key for r in urls.listed_at_fetch(captures, entries).where("blocked").collect()}
        assert got == {u: key for u in (url, "http://b.com/x/1") if u == url or key in listed[2:]}
    names = ["key", "since", "until", "action", "rank", "k", "at", "bucket", "hit", "copies", "own", "listed_key", "copy of the row"]
    odd = captures.selectExpr("*", *[f"'{n}' AS `{n}`" for n in names])
    got = urls.listed_at_fetch(odd, entries, names)
    assert got.count() == 3 and all(r[n] == n for r in got.collect() for n in names if n not in ("action", "listed_key"))
    assert urls.listed_at_fetch(captures.where("false"), entries).count() == 0 and urls.listed_at_fetch(captures, entries.where("false")).where("blocked").count() == 0


def test_names_that_are_used_inside(spark, docs):
    names = ["__gone", "__id", "__row", "__body", "id", "row", "gone", "body", "doc", "pos", "h1", "keeper", "__key", "key", "order", "place", "least", "sum", "__spans", "__items", "__n_words", "__text", "cleaned", "n"]
    odd = docs.selectExpr("doc_id", "text", "source", *[f"'{n}' AS `{n}`" for n in names])
    bench = spark.createDataFrame([(1, "no such words")], "item_id bigint, text string")
    for made in (lines.drop_shared_lines(odd), mixing.mixed(odd), decontaminate.remove_items(odd, bench)):
        assert made.columns[: len(odd.columns)] == odd.columns
        kept = made.collect()
        assert kept and all(r[n] == n for r in kept for n in names)


def test_empty_tables(spark, labels):
    empty = spark.createDataFrame([], SCHEMA)
    bench = spark.createDataFrame([], "item_id bigint, text string")
    for made in (lines.drop_shared_lines(empty), repeats.remove_repeats(empty), decontaminate.remove_items(empty, bench), mixing.mix(empty), quality.apply_rules(empty, labels), toxicity.score_toxicity(empty, toxicity.label_columns(labels), toxicity.CATEGORIES), language.predict_language(empty.select("text"), empty)):
        assert made.count() == 0
    assert html.extract_text(spark.createDataFrame([], "html string, url string")).count() == 0


def test_pipeline(spark, tmp_path, rows, labels):
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, rows[3][1])], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.columns[: len(rows[0])] == [f.split()[0] for f in SCHEMA.split(", ")]
    ids = [r.doc_id for r in out.collect()]
    assert ids and len(ids) == len(set(ids))


def test_texts_of_slices():
    import pyarrow as pa

    t = Texts(pa.array(["aa", None, "", "bcd"]).slice(1))
    assert t.n == 3 and t.buf.tobytes() == b"bcd" and t.missing.tolist() == [True, False, False]
    assert hashlib.sha256(b"").hexdigest()
