import random
import re

import brute
import pytest

from meltline.llm import bpe, decontaminate, exact, licenses, minhash, pii, quality, shards, substrings, urls
from meltline.llm.common import components

DOCS = "doc_id long, text string"
WORDS = "the of and to in that on is was he for it with as his at be by had not are but from or have an they which one you were all her".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "", "s", "er", "ing"]) for _ in range(n))


def edited(rng, text, n):
    w = text.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = prose(rng, 1) + "x"
    return " ".join(w)


@pytest.fixture(scope="module")
def corpus():
    """Copies, near copies with more and more edits, shared passages, nulls, empty and odd texts, a long one."""
    rng = random.Random(11)
    texts = [None, "", " \t\n", "one", "One", "one two", "Eins\u00a0zwei \u00c4", "\x00\x1f", "a" * 5000, "one", None]
    for _ in range(6):
        base = prose(rng, rng.choice([8, 40, 120, 300]))
        texts += [base, base.upper(), base.replace(" ", "  \n"), *(edited(rng, base, k) for k in (1, 1, 2, 4, 7, 12, 20, 40))]
    passage = prose(rng, 70)
    texts += [f"{prose(rng, 30)} {passage} {prose(rng, 30)}" for _ in range(5)] + [passage, f"{passage} {passage}", prose(rng, 20_000)]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    return [(i * 3 + 1, t) for i, t in zip(ids, texts)]


@pytest.fixture(scope="module")
def docs(spark, corpus):
    """The corpus with extra columns whose names the operators use inside."""
    rows = [(i, t, 7, "x", None) for i, t in corpus]
    return spark.createDataFrame(rows, DOCS + ", key int, shard string, bands array<int>").repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def rows(df, *columns):
    got = [tuple(r) for r in df.select(*columns).collect()]
    assert len(set(got)) == len(got)
    return set(got)


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates(docs, corpus, empty, size):
    got = minhash.near_duplicates(docs, size, 80)
    assert rows(got, "doc_id", "n_shingles", "component_id", "kept") == brute.near_duplicates(corpus, size)
    assert minhash.near_duplicates(empty, size).count() == 0


def test_near_duplicates_of_a_chain(spark):
    """A large bucket whose members are linked to each other but many of them not to its smallest id."""
    rng = random.Random(2)
    base = prose(rng, 150)
    texts = [edited(rng, base, 14)] + [edited(rng, base, rng.choice([0, 1, 5, 9, 13])) for _ in range(60)]
    corpus = list(enumerate(texts))
    got = minhash.near_duplicates(spark.createDataFrame(corpus, DOCS))
    assert rows(got, "doc_id", "n_shingles", "component_id", "kept") == brute.near_duplicates(corpus)


def test_repeated_rows_are_one_node(spark):
    d = spark.createDataFrame([(1, "a b c d"), (1, "a b c d"), (2, "a b c d")], DOCS)
    assert [tuple(r) for r in minhash.near_duplicates(d).orderBy("doc_id").collect()] == [(1, 3, 1, True), (1, 3, 1, True), (2, 3, 1, False)]


def test_densified_bins_agree_as_often_as_the_sets(spark):
    import numpy as np

    rng = np.random.default_rng(0)
    for n in (5, 60, 3000):
        x = np.unique(rng.integers(0, 1 << 63, n, np.uint64))
        y = np.unique(np.r_[x[: int(n * 0.9)], rng.integers(0, 1 << 63, n - int(n * 0.9), np.uint64)])
        same = minhash.bands([x, x])
        assert (same[0] == same[1]).all()
        assert (minhash.bands([x])[0] == minhash.bands([y])[0]).sum() > 0


def test_components(spark):
    import networkx_free

    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)]
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == networkx_free.components(edges)


def test_bpe_equals_the_library(spark, docs, corpus, empty):
    import public_tokenizers as P
    import tiktoken

    path = P.path("byte_bpe_50k.tiktoken")
    encoding = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    ids = {i: encoding.encode_ordinary(t or "") for i, t in corpus}
    want = {(i, len(ids[i]), brute.sha(" ".join(map(str, ids[i]))), brute.sha(t or "")) for i, t in corpus}
    got = bpe.tokenised(docs, path, P.PATTERN, with_ids=True)
    assert rows(got, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == want
    assert {r.doc_id: list(r.ids) for r in got.collect()} == ids
    assert bpe.tokenised(empty, path, P.PATTERN).count() == 0


def test_bpe_on_odd_texts_and_another_pattern():
    import public_tokenizers as P
    import tiktoken

    rng = random.Random(5)
    letters = [chr(c) for c in [*range(0x180), *range(0x2000, 0x2010), 0x85, 0x3000, 0x4E00, 0x1F600, 0x10FFFF]] + list("aeinth  ") * 30
    for name, pattern in (("byte_bpe_50k.tiktoken", P.PATTERN), ("byte_bpe_multi_50k.tiktoken", r"\s+|\S+")):
        path = P.path(name)
        encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
        for n in [*range(60)] * 4 + [9000]:
            t = "".join(rng.choices(letters, k=n))
            got = bpe.encode(t, path, pattern)
            assert got == encoding.encode_ordinary(t)
            assert bpe.decode(got, path, rng.randint(1, 7)) == t.encode()


def test_streaming_decoder_holds_back_unfinished_characters():
    decoder = bpe.StreamingDecoder({i: bytes([i]) for i in range(256)})
    out = [decoder.push([b]) for b in "a\u00e9\u20ac\U0001f600".encode()]
    assert out == [b"a", b"", "\u00e9".encode(), b"", b"", "\u20ac".encode(), b"", b"", b"", "\U0001f600".encode()]
    assert decoder.push([0xE2, 0x82]) == b"" and decoder.end() == b"\xe2\x82"
    assert decoder.push([0xFF, 0x41]) + decoder.end() == b"\xffA"


def test_pii(spark, empty):
    texts = [
        "card 4111 1111 1111 1111, again 4111-1111-1111-1111, wrong 4111 1111 1111 1112", "born 1987-02-03 or 31.12.1999, not 30.02.2001 nor 2021-13-01", "a.b@x.example.org and (310) 555-4510",
        "10.20.30.40 but 999.1.1.1 and v1.2.3", "GB82 WEST 1234 5698 7654 32", 'token = "1eb9c654e721b4f812088970e66a6345"', "no 12 data 3.14 here, 1,000,000 rows", None, "",
    ]
    d = spark.createDataFrame([*enumerate(texts), (50, texts[0])], DOCS)
    got = {r.doc_id: r for r in pii.pseudonymised(d, "k").collect()}
    first = got[0].text
    a, b = first[5:24], first[32:51]
    assert a.replace(" ", "") == b.replace("-", "") != "4111111111111111" and pii.luhn(a.replace(" ", "")[:-1]) == int(a[-1]) and "4111 1111 1111 1112" in first
    assert got[50].text == first and got[0].n_found == 2 and got[0].kinds == {"card": 2}
    assert "30.02.2001" in got[1].text and "2021-13-01" in got[1].text and "1987-02-03" not in got[1].text and got[1].n_found == 2
    assert "a.b@" not in got[2].text and "@x.example.org" in got[2].text and "555-4510" not in got[2].text
    assert "10.20.30.40" not in got[3].text and "999.1.1.1" in got[3].text
    packed = got[4].text.replace(" ", "")
    assert pii.mod97(packed[4:] + packed[:4]) == 1 and got[4].text != texts[4]
    assert "1eb9c654" not in got[5].text and got[6].text == texts[6] and got[7].text is None and got[8].text == ""
    assert [len(got[i].text) == len(texts[i]) for i in range(7)] == [True] * 7
    assert {r.text for r in pii.pseudonymised(d.where("doc_id = 0"), "other").collect()} != {first}
    assert pii.pseudonymised(empty, "k").count() == 0


@pytest.mark.parametrize("text, clear, kinds", [
    ("card 4111111111111111 97.51.17.173", "4111111111111111 97.51.17.173", "card ip"), ("4111 1111 1111 1111 12/05/2020", "4111 1111 1111 1111 12/05/2020", "card day"),
    ("5 4111111111111111", "4111111111111111", "card"), ("2023 123-45-6789", "123-45-6789", "ssn"), ("1234 212-555-0100", "212-555-0100", "phone"), ("212-555-0100 123", "212-555-0100", "phone"),
    ("name,4111111111111111,x", "4111111111111111", "card"), ("17,4111111111111111,123-45-6789", "4111111111111111 123-45-6789", "card ssn"), ("BE71 0961 2345 6769 2023", "0961", "iban"),
    ("+44 20 7946 0958 2023", "7946", "intl"), ("1,000,000 rows, 4,212 555 0100", "", ""),
])
def test_pii_beside_numbers(text, clear, kinds):
    out, counts = pii.Pseudonyms(b"k").text(text)
    assert " ".join(sorted(counts)) == " ".join(sorted(kinds.split())) and len(out) == len(text) and (out != text) == bool(kinds)
    assert not any(value in out for value in clear.split() if len(value) > 4 or value in ("0961", "7946"))


def test_pii_any_area_code_where_spelled_as_phone():
    texts = ["+1 (017) 555-7713", "+1 (117) 555-7713", "(017) 555-7713", "(310) 555-7713", "017-555-7713"]
    out = [pii.Pseudonyms(b"k").text(x)[0] for x in texts]
    digits = [re.sub(r"\D", "", x)[-10:] for x in out]
    assert [a != b for a, b in zip(texts, out)] == [True, True, True, True, False] and len(set(digits)) == 4
    assert digits[0] == digits[2] and {d[0] in "01" for d in digits[:3]} == {True} and digits[3][0] in "23456789" and all(d[3] in "23456789" for d in digits)


def test_pii_equal_cards_beside_any_number():
    p = pii.Pseudonyms(b"k")
    assert {p.text(f"4111111111111111 {n}")[0][:16] for n in range(200)} == {p.text(f"{n} 4111111111111111")[0][-16:] for n in range(200)} == {p.text("4111111111111111")[0]}


@pytest.mark.parametrize("size", [2, 3, 10, 97, 1000])
def test_permutations(size):
    p = pii.Permutation(b"key", "t", size)
    out = [p(x) for x in range(size)]
    assert sorted(out) == list(range(size)) and all(a != b for a, b in enumerate(out))


def test_shards(spark, docs, corpus, empty):
    import xxhash  # noqa: F401
    from pyspark.sql import functions as F

    got = shards.sharded(docs, 7).collect()
    text = dict(corpus)
    assert sorted(r.doc_id for r in got) == sorted(text)
    assert all(r["size"] == len((text[r.doc_id] or "").encode()) + 16 and r.text_crc32 == brute.crc(text[r.doc_id]) and r.law == "bytes" and r.grown_shard is None for r in got)
    of = {}
    for r in got:
        assert of.setdefault(text[r.doc_id] or "", r.shard) == r.shard
    for s in {r.shard for r in got}:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    keys = {r.t: r.k for r in docs.select(F.coalesce("text", F.lit("")).alias("t")).distinct().withColumn("k", F.xxhash64("t")).collect()}
    loads = {}
    for r in got:
        loads[r.shard] = loads.get(r.shard, 0) + r["size"]
    assert sorted(loads.values()) == brute.sharded_capacity(corpus, keys.__getitem__, 7)
    assert shards.sharded(empty, 7).count() == 0


def test_shards_of_many_groups(spark):
    rng = random.Random(8)
    corpus = [(i, prose(rng, rng.randint(1, 30))) for i in range(3000)] + [(i, "same text") for i in range(3000, 4500)]
    d = spark.createDataFrame(corpus, DOCS)
    got = shards.sharded(d, 40).groupBy("shard").sum("size").collect()
    from pyspark.sql import functions as F

    keys = {r.text: r.k for r in d.select("text", F.xxhash64("text").alias("k")).distinct().collect()}
    assert sorted(r[1] for r in got) == brute.sharded_capacity(corpus, keys.__getitem__, 40)


def test_exact_duplicates(docs, corpus, empty, spark):
    got = exact.exact_duplicates(docs)
    assert rows(got, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == brute.exact_duplicates(corpus)
    assert exact.exact_duplicates(empty).count() == 0


def test_heavy_texts_are_settled_without_a_shuffle(spark):
    corpus = [(i, f"text {i}" if i % 3 else "hot  text" if i % 2 else "hot text") for i in range(9000, 0, -1)]
    d = spark.createDataFrame(corpus, DOCS).repartition(3)
    from pyspark.sql import functions as F

    digests = d.select("doc_id", F.unhex(F.sha2(exact.normalised(F.col("text")), 256)).alias("digest"))
    assert [(r.keep_id, r.group_size) for r in exact.frequent(digests).collect()] == [(3, 3000)]
    assert rows(exact.exact_duplicates(d), "doc_id", "keep_id", "group_size", "kept", "text_sha256") == brute.exact_duplicates(corpus)


def test_misra_gries_keeps_what_is_frequent():
    counts = {}
    for k in range(100):
        counts = exact.misra_gries(counts, {"a": 3, f"x{k}": 2, f"y{k}": 1}, 3)
    assert "a" in counts and counts["a"] <= 300 and len(counts) <= 3


def test_licences(spark, docs, corpus, empty):
    texts = [
        "Licensed under the Apache License, Version 2.0.", "SPDX-License-Identifier: MIT", "Licensed under CC BY-NC 4.0. cc-by CC BY", "GNU General Public License version 3; all rights   Reserved",
        "Permission is hereby granted, free of charge, to any person obtaining a copy", "a licence to read", "cc\u00e9 by, call rights reserved", "General Public License general public license",
    ]
    d = spark.createDataFrame([*((1000 + i, t) for i, t in enumerate(texts)), *corpus], DOCS)
    every = [(1000 + i, t) for i, t in enumerate(texts)] + corpus
    got = licenses.scanned(d)
    assert rows(got, "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels") == brute.licence_base(every)
    labels = {r.doc_id - 1000: (r.labels, r.score) for r in got.where("doc_id >= 1000").collect()}
    assert [labels[i][0] for i in range(8)] == ["apache-2.0", "mit", "cc-by,cc-by-nc-4.0", "gpl,gpl-3.0,reserved", "mit", "", "", "gpl"]
    assert labels[0][1] == 1.0 and labels[5][1] == 0.0 and all(0 <= s <= 1 for _, s in labels.values())
    assert licenses.scanned(empty).count() == 0 and len(licenses.rules()) > 200


def spellings(parsed):
    """What a parsed rule matches: each alternative, optional parts with and without, one digit for all."""
    out = [""]
    for op, arg in parsed:
        match str(op):
            case "LITERAL":
                more = [chr(arg)]
            case "IN":
                more = [chr(a) for o, a in arg if str(o) == "LITERAL"] or ["7"]
            case "BRANCH":
                more = [x for branch in arg[1] for x in spellings(branch)]
            case "SUBPATTERN":
                more = spellings(arg[-1])
            case "MAX_REPEAT":
                more = [*([""] if arg[0] == 0 else []), *spellings(arg[2])]
        out = [a + b for a in out for b in more]
    return out


def test_licence_gates_let_every_rule_through():
    gate = re.compile("|".join(licenses.families()))
    bad = []
    for label, keyword, pattern, _ in licenses.rules():
        for text in spellings(re._parser.parse(pattern.removeprefix(licenses.GRANT))):
            if not (re.fullmatch(pattern.removeprefix(licenses.GRANT), text) and keyword in text and gate.search(f" {text} ")):
                bad.append((label, keyword, text))
    assert not bad


def test_licence_names_without_the_word(spark):
    texts = ["Released under Apache v2.0", "see the Unicode terms of use", "X Consortium License", "Open Data Commons Database License", "without any warranty", "MIT No Attribution", "MIT-0"]
    got = {r.doc_id: r.labels.split(",") for r in licenses.scanned(spark.createDataFrame(list(enumerate(texts)), DOCS)).collect()}
    assert all(label in got[i] for i, label in enumerate(["apache-2.0", "unicode", "x11", "odbl-1.0", "no-warranty", "mit-0", "mit-0"])), got


def test_licence_intervals(spark):
    d = spark.createDataFrame([(1, "mit license here " * 3 + "licensed under the mit license and licensed under the gnu general public license version 2 0")], DOCS)
    found = [(x.label, x.priority) for x in licenses.scanned(d).first().detections]
    assert found == [("mit", 1)] * 3 + [("mit", 3), ("gpl-2.0", 3)]


@pytest.mark.parametrize("size", [50, 3])
def test_substrings(docs, corpus, empty, size):
    got = substrings.deduplicated(docs, size)
    assert rows(got, "doc_id", "n_words", "n_removed", "kept_sha256") == brute.substrings(corpus, size)
    assert {r.doc_id: brute.sha(r.kept_text) for r in got.collect()} == {i: h for i, _, _, h in brute.substrings(corpus, size)}
    assert substrings.deduplicated(empty).count() == 0


def test_hot_grams_are_settled_window_by_window(spark, monkeypatch):
    rng = random.Random(9)
    passage = prose(rng, 60)
    corpus = [(i, f"{prose(rng, 5)} {passage} {i}") for i in range(80)]
    monkeypatch.setattr(substrings._repeats, "__defaults__", (3,))
    got = substrings.deduplicated(spark.createDataFrame(corpus, DOCS))
    assert rows(got, "doc_id", "n_words", "n_removed", "kept_sha256") == brute.substrings(corpus)


def test_urls(spark):
    given = [
        "http://Example.ORG/es/x?y", "https://a.b.example.org/en/12", "https://example.org/en/2", "http://notexample.org/es/", "http://x.com/fr/", "http://x.com/de", "http://com/de/1", "ftp://org", "org/es/",
        None, "", "http://m.example.com/de/#x", "http://h/p://q/r", "http://example.org?/es/",
    ]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate([*given, given[0]])], "page_id long, url string, rule string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.filtered(pages).collect()}
    assert len(got) == 15 and got[14] == got[0]
    want = [
        ("example.org", "/es/x", "example.org/es/", "block"), ("a.b.example.org", "/en/12", "example.org/en/1", "block"), ("example.org", "/en/2", "org/", "allow"), ("notexample.org", "/es/", "org/", "allow"),
        ("x.com", "/fr/", "com/fr/", "allow"), ("x.com", "/de", None, "allow"), ("com", "/de/1", "com/de/", "block"), ("org", "", None, "allow"), ("", "", None, "allow"),
        ("", "", None, "allow"), ("", "", None, "allow"), ("m.example.com", "/de/", "com/de/", "block"), ("h", "/p://q/r", None, "allow"), ("example.org", "", None, "allow"),
    ]
    assert [got[i] for i in range(14)] == want
    assert {r.verdict for r in urls.filtered(pages, [], "block").collect()} == {"block"}
    assert urls.filtered(pages.where("false")).count() == 0


def test_decontamination(docs, corpus, empty, spark, monkeypatch):
    rng = random.Random(3)
    long = next(t for _, t in corpus if t and 80 < len(t.split()) < 200)
    items = [(1, " ".join(long.split()[5:30])), (10, " ".join(long.split()[5:30])), (2, "one"), (3, "One, TWO!"), (4, None), (5, ""), (6, prose(rng, 40)), (7, "the of the of the of the of the of the of")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    want = brute.leaks(corpus, items)
    columns = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert rows(decontaminate.decontaminated(docs, benchmark), *columns) == want
    monkeypatch.setattr(decontaminate, "BLOCK", 30)
    assert rows(decontaminate.decontaminated(docs, benchmark), *columns) == want
    assert decontaminate.decontaminated(empty, benchmark).count() == 0
    assert {r.contaminated for r in decontaminate.decontaminated(docs, benchmark.where("false")).collect()} == {False}


def test_quality(spark, empty):
    rng = random.Random(1)
    good = [(i, ". ".join(prose(rng, 12).capitalize() for _ in range(6))) for i in range(300)]
    bad = [(i, rng.choice([" | ".join(prose(rng, 30).split()), "### ".join(prose(rng, 30).split()), " ".join([prose(rng, 1)] * 40)])) for i in range(300, 400)]
    d = spark.createDataFrame([*good, *bad, (1000, None), (1001, "")], DOCS)
    labels = spark.createDataFrame([(i, int(i < 300), 0) for i in range(400)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in quality.scored(d, labels).collect()}
    out = [r for r in got.values() if r.held_out and r.doc_id < 1000]
    assert len(out) > 80 and sum(r.predicted == int(r.doc_id < 300) for r in out) / len(out) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values()) and got[1000].score == got[1001].score
    assert {r.score for r in quality.scored(d, labels.where("false")).collect()} == {0.5}
    assert {r.predicted for r in quality.scored(d, labels.where("quality = 1")).collect()} == {1}
    assert quality.scored(empty, labels).count() == 0


SHARED = [(5, "unique text A of some words " * 3), (5, "same text " * 9), (3, "same text " * 9), (None, "same text " * 9), (None, None), (7, ""), (7, "")]


@pytest.mark.parametrize("few", [1_000_000, 0])
def test_substrings_tell_rows_of_one_doc_id_apart(spark, monkeypatch, few):
    monkeypatch.setattr(substrings, "FEW", few)
    monkeypatch.setattr(substrings._repeats, "__defaults__", (1,))
    rng = random.Random(3)
    passage = prose(rng, 60)
    corpus = [(1, passage), (2, f"own words {passage}"), (2, "a short text"), (2, f"other own {passage} end"), (None, passage), (4, None), *[(i, f"w{i} {passage}") for i in range(10, 40)]]
    got = rows(substrings.deduplicated(spark.createDataFrame(corpus, DOCS)), "doc_id", "n_words", "n_removed")
    assert {(1, 60, 0), (2, 62, 60), (2, 3, 0), (2, 63, 60), (None, 60, 0), (4, 0, 0)} <= got and all(r[2] == 60 for r in got if r[0] and r[0] >= 10)
    assert substrings.deduplicated(spark.createDataFrame(corpus, DOCS)).count() == len(corpus)


def test_operators_on_shared_and_missing_doc_ids(spark):
    import public_tokenizers as P

    d = spark.createDataFrame(SHARED, DOCS)
    near = minhash.near_duplicates(d)
    assert near.count() == len(SHARED) and all(r.component_id is None and r.kept for r in near.where("doc_id IS NULL").collect())
    assert {r.component_id for r in near.where("doc_id = 3").collect()} == {3}
    for got in (exact.exact_duplicates(d), shards.sharded(d, 4), bpe.tokenised(d, P.path("byte_bpe_50k.tiktoken"), P.PATTERN), pii.pseudonymised(d, "k"), licenses.scanned(d)):
        assert got.count() == len(SHARED)


def test_decontamination_takes_items_without_an_id(spark):
    text = "one two three four five six seven eight nine ten eleven"
    items = spark.createDataFrame([(None, text, 1), ("b", "other words", 2), (None, None, 3)], "item_id string, text string, spans int")
    d = spark.createDataFrame([(1, f"x {text} y"), (None, text), (3, "none of it")], DOCS)
    got = {r.doc_id: (r.n_hit, r.n_items, r.contaminated) for r in decontaminate.decontaminated(d, items).collect()}
    assert got == {1: (11, 1, True), None: (11, 1, True), 3: (0, 0, False)}
