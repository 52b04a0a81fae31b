"""Tokens, languages, toxicity and URLs: exact comparisons, held-out accuracy, edge cases."""

import random
from collections import Counter
from types import SimpleNamespace

import numpy as np
import plain
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from siltstone.llm import bpe, langid, token_counts, toxicity, url_filter

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def read(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


def test_encoding_equals_the_library(tokenizer):
    rnd = random.Random(1)
    texts = ["".join(rnd.choice("abcdehinorst") for _ in range(rnd.randint(1, 40))) for _ in range(3000)]
    texts += ["".join(rnd.choice("aé<|>ñ日😀's lt!.19ΑΣŉİ\u0345") for _ in range(rnd.randint(1, 60))) for _ in range(3000)]
    texts += [t for t in plain.EDGE_TEXTS if t is not None] + ["<|endoftext|>A<|startoftext|> <|x|>", "!" * 3000, "ab" * 3000]
    encoder = bpe.Encoder(bpe.load(bpe.default_path()))
    for text, want in zip(texts, tokenizer.encode_batch(texts, add_special_tokens=False), strict=True):
        assert encoder.encode(text) == want.ids, text[:60]


def test_code_points_of_all_scripts(tokenizer):
    points = [c for c in range(1, 0x30000) if not 0xD800 <= c < 0xE000]
    texts = [f"a{chr(c)}b {chr(c)}" for c in points]
    encoder = bpe.Encoder(bpe.load(bpe.default_path()))
    wrong = [hex(c) for c, t, w in zip(points, texts, tokenizer.encode_batch(texts, add_special_tokens=False)) if encoder.encode(t) != w.ids]
    assert wrong == []


def test_forgetting_words_changes_nothing(monkeypatch):
    text = " ".join(f"word{i % 50} thing{i}" for i in range(500))
    vocabulary = bpe.load(bpe.default_path())
    want = bpe.Encoder(vocabulary).encode(text)
    monkeypatch.setattr(bpe, "CACHE_WORDS", 3)
    monkeypatch.setattr(bpe, "TABLE_PAIRS", 3)
    assert bpe.Encoder(vocabulary).encode(text) == want


def test_words_met_lately_are_not_encoded_again(monkeypatch, tokenizer):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 50)
    vocabulary = bpe.Vocabulary(bpe.default_path())
    encoder, made = bpe.Encoder(vocabulary), Counter()
    plainly = vocabulary.encode_word
    monkeypatch.setattr(vocabulary, "encode_word", lambda word: made.update([word]) or plainly(word))
    text = " ".join(f"often {''.join(chr(97 + int(d)) for d in str(i))}x" for i in range(1000))
    assert encoder.encode(text) == tokenizer.encode(text, add_special_tokens=False).ids
    assert made[b"often"] == 1 and len(made) == 1001


def test_texts_met_lately_are_not_cut_again(tokenizer):
    encoder, cut = bpe.Encoder(bpe.load(bpe.default_path())), []
    pattern = encoder._pattern
    encoder._pattern = SimpleNamespace(findall=lambda text: cut.append(text) or pattern.findall(text))
    text = "It's 1st,\nÉté\u3000plus\x1cun...\tend \r\n  'tis"
    want = tokenizer.encode(text, add_special_tokens=False).ids
    assert encoder.encode(text) == want and cut
    cut.clear()
    assert encoder.encode(text) == want and cut == []


def test_newer_letters_do_not_mislead_later_texts(tokenizer):
    # U+1C89 and U+10D4A are letters since Unicode 16.
    texts = ["a\u1c89b 1\U00010d4a", "a b 1", "a\u1c89b!1 \U00010d4a", "b!1 a"] * 2
    encoder = bpe.Encoder(bpe.load(bpe.default_path()))
    assert [encoder.encode(t) for t in texts] == [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_words_longer_than_a_window(monkeypatch, tokenizer):
    rnd = random.Random(5)
    words = ["".join(rnd.choice(letters) for _ in range(n)) for letters in ("etaoin", "日本語é", "!?.") for n in (60, 130, 500, 5000)]
    for window in (1, 7, bpe.WINDOW):
        monkeypatch.setattr(bpe, "WINDOW", window)
        encoder = bpe.Encoder(bpe.load(bpe.default_path()))
        assert [encoder.encode(w) for w in words] == [e.ids for e in tokenizer.encode_batch(words, add_special_tokens=False)]


def test_lists_of_a_batch(tokenizer):
    texts = [None, b"", b" \n", "ça <|endoftext|> va".encode(), b"x  y"]
    lists = bpe.Encoder(bpe.load(bpe.default_path())).lists(texts)
    want = [tokenizer.encode((t or b"").decode(), add_special_tokens=False).ids for t in texts]
    assert lists.to_pylist() == want
    decoded = bpe.offset_table(bpe.default_path()).decode(lists)
    assert decoded.to_pylist() == [tokenizer.decode(w, skip_special_tokens=False) for w in want]
    assert bpe.offset_table(bpe.default_path()).decode(lists[2:4]).to_pylist() == decoded.to_pylist()[2:4]


def test_bpe_edges(spark, tokenizer):
    docs = plain.edge_docs(spark)
    encoded = bpe.encode(docs, ["doc_id", "text"])
    rows = bpe.decode(encoded, ["doc_id", "text", "ids"]).collect()
    assert len(rows) == docs.count()
    for r in rows:
        want = tokenizer.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["ids"] == want and r["decoded"] == tokenizer.decode(want, skip_special_tokens=False)
    once = bpe.round_trip(docs, ["doc_id", "text"]).collect()
    assert sorted(map(tuple, once), key=str) == sorted(((r["doc_id"], r["text"], r["ids"], r["decoded"]) for r in rows), key=str)
    assert bpe.decode(bpe.encode(plain.empty_docs(spark))).collect() == []


def test_decoding_nulls(spark):
    frame = spark.createDataFrame([(1, None), (2, []), (3, [320, 49407])], "doc_id long, ids array<int>")
    assert [tuple(r) for r in bpe.decode(frame).collect()] == [(1, ""), (2, ""), (3, "a</w> <|endoftext|>")]


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_sections_keep_all_tokens(spark, rule):
    docs = plain.edge_docs(spark)
    rows = token_counts.count_sections(docs.select("doc_id", "text", "section"), rule=rule).groupBy("doc_id").agg(F.sum("n_tokens").alias("n")).collect()
    encoding, _ = token_counts.load(token_counts.default_path())
    want = {}
    for r in docs.select("doc_id", "text").collect():
        want[r["doc_id"]] = want.get(r["doc_id"], 0) + len(encoding.encode_ordinary(r["text"] or ""))
    assert {r["doc_id"]: round(r["n"], 6) for r in rows} == want


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_allocation_against_characters(rule):
    rnd = random.Random(4)
    for _ in range(200):
        end = rnd.randint(1, 30)
        cuts = sorted(rnd.sample(range(end), rnd.randint(1, end)))
        starts = np.array(cuts)
        stops = np.array([*cuts[1:], end])
        sections = np.array([0, *sorted(rnd.sample(range(1, end), rnd.randint(0, min(4, end - 1))))])
        got, crossing = token_counts.allocate(starts, stops, sections, end, rule)
        owner = [max(i for i, s in enumerate(sections) if s <= c) for c in range(end)]
        want = [0.0] * len(sections)
        for a, b in zip(starts, stops):
            held = owner[a:b]
            if rule == "share":
                for h in held:
                    want[h] += 1 / len(held)
            else:
                most = max(sorted(set(held)), key=held.count)
                want[{"first": held[0], "last": held[-1], "most": most}[rule]] += 1
        assert np.allclose(got, want)
        assert (crossing > 0).any() == any(len(set(owner[a:b])) > 1 for a, b in zip(starts, stops))


def test_section_borders(spark):
    rows = token_counts.count_sections(spark.createDataFrame([(1, "ab\ncd"), (2, "ab\n"), (3, None), (4, "é\n日")], "doc_id long, text string"))
    spans = sorted((r["doc_id"], r["section"], r["start"], r["stop"]) for r in rows.collect())
    assert spans == [(1, 0, 0, 3), (1, 1, 3, 5), (2, 0, 0, 3), (3, 0, 0, 0), (4, 0, 0, 2), (4, 1, 2, 3)]


def test_languages_held_out(spark):
    docs = read(spark, "documents")
    held_out = langid.remainder(F.col("doc_id"), 5) == 0
    prototypes = langid.learn(docs.where(~held_out))
    assert sorted(prototypes) == ["de", "en", "es", "fr"]
    judged = langid.predict(docs.where(held_out), prototypes, ["doc_id", "lang"]).collect()
    assert sum(r["lang"] == r["lang_pred"] for r in judged) >= 0.98 * len(judged)
    assert all(0 <= r["score"] <= 1 for r in judged)


def test_language_vectors_against_the_definition():
    first, second, third = langid._letters()
    text = "Été abc, z"
    classes = [int(langid.letter_classes()[ord(c)]) for c in " été abc z "]
    want = sum(first[a] * second[b] * third[c] for a, b, c in zip(classes, classes[1:], classes[2:]))
    assert np.array_equal(langid.vectors([text.encode()])[0], want)
    assert not langid.vectors([None, b"", b"12 ||"]).any()


def test_language_edges(spark):
    docs = plain.edge_docs(spark)
    prototypes = langid.learn(docs)
    rows = langid.predict(docs, prototypes, ["doc_id", "text"]).collect()
    assert len(rows) == docs.count()
    for r in rows:
        blank = not any(map(str.isalpha, r["text"] or ""))
        assert (r["lang_pred"] == "und") == blank and (r["score"] == 0) >= blank
    assert langid.learn(plain.empty_docs(spark)) == {}
    assert {r["lang_pred"] for r in langid.predict(docs, {}).collect()} == {"und"}


def test_toxicity_held_out(spark):
    docs, labels = read(spark, "documents"), read(spark, "labels")
    held_out = langid.remainder(F.col("doc_id"), 3) == 1
    machine = toxicity.learn(docs, labels.where(~held_out))
    rows = toxicity.score(docs, machine).join(labels, "doc_id").where(held_out).collect()
    insults = [r for r in rows if r["toxic"]]
    clean = [r for r in rows if not r["toxic"]]
    assert sum(r["predicted"] for r in insults) >= 0.8 * len(insults)  # learnt from 33 toxic texts
    assert sum(r["predicted"] for r in clean) <= 0.01 * len(clean)
    calm = "the and of to in"
    told = "the and idiot of to moron in stupid trash"
    spaced, gapped = "the and i d i o t of m o r o n to s t u p i d in t.r.a.s.h", "the and idixot of mor0on to stu-pid in traash"
    frame = spark.createDataFrame(list(enumerate([calm, told, spaced, gapped, None, ""])), "doc_id long, text string")
    score = {r["doc_id"]: r["score"] for r in toxicity.score(frame, machine).collect()}
    assert min(score[1], score[2], score[3]) > score[0]
    assert all(0 <= s <= 1 for s in score.values())


def test_spaced_letters_are_joined_in_any_text():
    assert "fool" in toxicity.tokens(b"You f o o l")
    assert "moron" in toxicity.tokens(b"You m o r o n")
    assert {"h-a-g", "hag,"} <= toxicity.tokens(b"one h - a - g\nof h a g, there")
    assert toxicity.tokens(b"I am a man") == {"I", "am", "a", "man"}


def test_long_units_are_cut_without_loss():
    for n in (1, 47, 48, 49, 88, 89, 500):
        word = "".join(chr(97 + i * i % 26) for i in range(n))
        parts = toxicity.pieces(word)
        assert all(len(p.strip(toxicity.CUT)) <= toxicity.PIECE for p in parts)
        held = {p.strip(toxicity.CUT)[i : i + toxicity.REACH] for p in parts for i in range(len(p))}
        assert all(word[i : i + toxicity.REACH] in held for i in range(n))
        assert [p[0] != toxicity.CUT for p in parts] == [True] + [False] * (len(parts) - 1)
        assert [p[-1] != toxicity.CUT for p in parts] == [False] * (len(parts) - 1) + [True]
    # What lies beyond the first piece is learnt from and found.
    tail = "q" * 60 + "moron"
    machine = toxicity.fit_machine(["moron", "morons"], ["apple", "garden", "letter", *toxicity.pieces("q" * 60)], np.ones(2))
    found = toxicity.margins([tail, "q" * 65], machine.table(), machine.bias)
    assert found[0] > found[1]


def test_kernel_against_the_definition():
    from itertools import combinations

    def weights(word):
        marked = f"^{word}$"
        out = {}
        for at in combinations(range(len(marked)), toxicity.ORDER):
            if at[-1] - at[0] < toxicity.REACH:
                key = "".join(marked[i] for i in at)
                out.setdefault(key, []).append(toxicity.DECAY ** (at[-1] - at[0] + 1))
        return out

    def value(a, b):
        a, b = weights(a), weights(b)
        def norm(x):
            return sum(w * w for ws in x.values() for w in ws) ** 0.5
        return sum(sum(a[k]) * sum(b[k]) for k in a if k in b) / (norm(a) * norm(b))

    words = ["idiot", "idixot", "stupid", "plain", "abababab", "on"]
    got = toxicity.kernel(words, words)
    assert np.allclose(got, [[value(a, b) for b in words] for a in words], atol=1e-5)
    assert got[0, 1] > 5 * got[0, 3]


def test_toxicity_edges(spark):
    docs = plain.edge_docs(spark)
    labels = spark.createDataFrame([(3, 1, "x"), (4, 0, "x"), (4, 1, "x"), (None, 1, "x"), (5, None, "x")], "doc_id long, toxic int, text string")
    machine = toxicity.learn(docs, labels)
    assert toxicity.score(docs, machine).count() == docs.count()
    flat = toxicity.learn(plain.empty_docs(spark), labels.limit(0))
    assert {r["predicted"] for r in toxicity.score(docs, flat).collect()} == {0}


URLS = [
    (1, "HTTP://Sub.Example.ORG/en/1234?x=/fr/"), (2, "https://example.org/es/7"), (3, "http://a.com/de/1#/fr/"), (4, "http://com/fr/x"),
    (5, None), (6, ""), (7, "no scheme/org/"), (8, "http://notorg/x"), (9, "http://x.org"), (10, "http://a://b.org/"), (11, "://org/?"),
    (12, "http://É.ORG/É"), (13, "http://badexample.org/es/1"), (14, "http://h.net/a\nb"), (1, "HTTP://Sub.Example.ORG/en/1234?x=/fr/"),
]


def test_url_rules(spark):
    pages = spark.createDataFrame(URLS, "page_id long, url string").withColumn("host", F.lit("clash"))
    rows = url_filter.judge(pages).collect()
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in rows}
    assert len(rows) == len(URLS)
    assert got[1] == ("sub.example.org", "/en/1234", "example.org/en/1", "block")
    assert got[2][2:] == ("example.org/es/", "block") and got[3][2:] == ("com/de/", "block") and got[4][2:] == ("com/fr/", "allow")
    for none in (5, 6, 7):
        assert got[none][:3] == ("", "", None)
    assert got[8][2] is None and got[9] == ("x.org", "", None, got[9][3])
    assert got[10][:2] == ("a:", "//b.org/") and got[11][:3] == ("org", "/", "org/")
    assert got[12][:3] == ("É.org", "/É", "org/") and got[13][2] == "org/" and got[14][1] == "/a\nb"
    for i, url in URLS:
        assert got[i][:2] == url_filter.split_url(url or "")
    assert url_filter.judge(pages.limit(0)).collect() == []


def test_url_model_on_hosts_it_has_not_seen(spark):
    rows = url_filter.judge(read(spark, "pages")).where("rule is null").select("host", "verdict").distinct().collect()
    unwanted = ("casino-win", "cheap-pills", "ads-track")
    right = [(r["verdict"] == "block") == any(u in r["host"] for u in unwanted) for r in rows]
    assert any(r["verdict"] == "block" for r in rows) and sum(right) >= 0.9 * len(right)


def test_url_model_cross_checked():
    model = url_filter.train([])
    assert model.probability(b"h", b"/p") == 0.5
    rows = [*((u, True) for u in url_filter.BLOCKED_URLS), *((u, False) for u in url_filter.ALLOWED_URLS)]
    right = 0
    for fold in range(5):
        model = url_filter.train([r for i, r in enumerate(rows) if i % 5 != fold])
        for url, bad in rows[fold::5]:
            host, path = url_filter.split_url(url)
            right += (model.probability(host.encode(), path.encode()) >= 0.5) == bad
    assert right >= 0.7 * len(rows)
