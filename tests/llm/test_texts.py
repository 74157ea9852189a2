"""Operators on texts: tokens, personal data, licenses, decontamination, quality."""

import base64
import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken

from runweave.llm import bpe, decontam, licenses, pii, quality, tokens

RANKS = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
PATTERN = public_tokenizers.PATTERN
KEY = b"a key of the tests"
ODD = [None, "", " ", "a", "é|\n|日本🙂 x", "it's 12 <|endoftext|>", "x" * 3000, "long word " * 3000, "\ufeff\u0301\n\n "]


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in RANKS.splitlines())}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_encoding_is_that_of_the_reference(reference):
    random.seed(5)
    texts = ODD + ["".join(random.choices("abcdetnr éß日\n .,!1'", k=n)) for n in range(0, 400, 7)]
    own = bpe.Encoder(RANKS, PATTERN)
    assert [x.tolist() for x in own.encode(texts)] == [reference.encode_ordinary(t or "") for t in texts]


@pytest.mark.parametrize("n", [2, 3, 9, 31, 64, 127])
def test_matrix_and_heap_agree(n):
    random.seed(n)
    own = bpe.vocabulary(RANKS)
    pieces = ["".join(random.choices("etaoinshr", k=n)).encode() for _ in range(40)]
    assert own.encode_rows(pieces, 128) == [own.encode_long(p) for p in pieces]


def test_encode_decode_and_digests(spark, reference):
    df = spark.createDataFrame([(i, t, "old", i) for i, t in enumerate(ODD)], "doc_id long, text string, ids string, n long")
    rows = bpe.decode(bpe.encode(df, RANKS, PATTERN), RANKS).orderBy("doc_id").collect()
    for r in rows:
        assert r.ids == reference.encode_ordinary(r.text or "")
        assert bytes(r.decoded) == (r.text or "").encode() and r.n == r.doc_id
    for r in bpe.digests(df, RANKS, PATTERN).collect():
        ids = reference.encode_ordinary(ODD[r.doc_id] or "")
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((ODD[r.doc_id] or "").encode()).hexdigest()
    assert bpe.encode(df.limit(0), RANKS, PATTERN).count() == 0


@pytest.mark.parametrize("rule", tokens.RULES)
def test_allotted_tokens_against_every_pair(rule):
    rng = np.random.default_rng(6)
    ends = np.cumsum(rng.integers(1, 5, 60))
    starts = np.concatenate(([0], ends[:-1]))
    begin = np.sort(rng.integers(0, 150, 12))
    end = begin + rng.integers(0, 20, 12)
    got, crossing = tokens.allot(starts, ends, begin, end, rule)
    want, cross = np.zeros(12), np.zeros(12, int)
    for a, z in zip(starts, ends):
        common = [max(0, min(z, end[i]) - max(a, begin[i])) for i in range(12)]
        for i, c in enumerate(common):
            if not c:
                continue
            weight = {"first": begin[i] <= a < end[i], "share": c / sum(common), "most": common.index(max(common)) == i}[rule]
            want[i] += weight
            cross[i] += weight > 0 and (a < begin[i] or z > end[i])
    assert np.allclose(got, want) and crossing.tolist() == cross.tolist()


def test_spans_cover_the_text_and_sections_make_it(reference):
    for text in ODD:
        text = text or ""
        starts, ends = tokens.token_spans(text, RANKS, PATTERN)
        assert len(starts) == len(reference.encode_ordinary(text))
        assert {i for a, b in zip(starts, ends) for i in range(a, b)} == set(range(len(text)))
        assert "".join(text[s["begin"] : s["end"]] for s in tokens.line_sections(text)) == text


def test_attribution_of_odd_rows(spark):
    df = spark.createDataFrame([(i, t, 7) for i, t in enumerate(ODD)] + [(None, "a\nb", 7)] * 2, "doc_id long, text string, tokens int")
    got = tokens.by_kind(tokens.attribute(df, RANKS, PATTERN, "share", tokens.line_sections)).collect()
    sums = {}
    for r in got:
        sums.setdefault(r.doc_id, [r.n_tokens, 0.0])[1] += r.tokens
    assert all(abs(n - s) < 1e-6 for d, (n, s) in sums.items() if d is not None) and sums[0] == [0, 0.0]
    fields = df.selectExpr("doc_id", "text", "array(named_struct('part', 'title', 'begin', 0, 'end', 1)) parts")
    assert tokens.attribute(fields, RANKS, PATTERN).count() == df.count()
    with pytest.raises(ValueError):
        tokens.attribute(fields, RANKS, PATTERN, "none")


PERSONAL = (
    "Mr. John Smith (j.smith@mail.example.com, +1 (957) 555-9688) and Frau Müller, 4111 1111 1111 1111, DE89370400440532013000, "
    '10.1.2.3, 123-45-6789, token = "dfd1944d2e84f15e89902e34b677eb5a8a7d42ab"; Sarah SMITH, Иван Петров, 0184490630827271.'
)


def test_surrogates_keep_form_and_identity():
    new, n = pii.rewrite(PERSONAL, {}, KEY)
    assert n == 14 and pii.rewrite(PERSONAL, {}, KEY) == (new, n) and pii.rewrite(PERSONAL, {}, KEY + b"2")[0] != new
    for value in ("Smith", "John", "j.smith", "957", "Müller", "4111", "DE89", "10.1.2.3", "123-45", "dfd19", "SMITH", "Иван", "Петров"):
        assert value not in new
    assert "0184490630827271" in new and "Mr. " in new and "Frau " in new
    m = re.match(r"Mr\. (\w+) (\w+) \([\w.]+@\w+\.example\.org, \+1 \(\d{3}\) 555-\d{4}\) and Frau \w+, (4\d{3}(?: \d{4}){3}), (DE\d{20}), ", new)
    assert m and not pii._luhn(m[3].replace(" ", "")) and pii._iban_rest(m[4]) == 1
    assert m[2].upper() in new  # Sarah SMITH shares the surname of Mr. Smith
    assert m[1].casefold() in {x.casefold() for x in pii.GIVEN["m", "LATIN"]}
    again = pii.mentions(new)
    assert [x[2] for x in again][:8] == [x[2] for x in pii.mentions(PERSONAL)][:8]


def test_surrogates_over_a_table(spark):
    rows = [(1, PERSONAL, 1), (1, PERSONAL, 1), (None, "mail a@b.example", 2), (3, None, 3), (4, "", 4), (5, "plain words", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_entities int")
    got = pii.replace(df, KEY)
    assert got.columns == df.columns
    by = {}
    for r in got.collect():
        by.setdefault(r.doc_id, []).append((r.text, r.n_entities))
    assert by[1][0] == by[1][1] and by[1][0][1] == 14 and by[3] == [(None, 0)] and by[4] == [("", 0)]
    assert by[5] == [("plain words", 0)] and "a@b" not in by[None][0][0]
    assert pii.replace(df.limit(0), KEY).count() == 0


def named(text):
    return [(text[a:b], kind, norm) for a, b, kind, norm in pii.mentions(text) if kind in ("given", "surname", "initial")]


def test_one_person_is_one_person():
    text = "Dr. Mary Jones met Mary Jones. Mary's friend said that Jones left, and JONES-led talks; mary jones and Joneses stay."
    got = named(text)
    assert {x[1:] for x in got} == {("given", "f LATIN mary"), ("surname", "n LATIN jones")}
    assert [x[0] for x in got] == ["Mary", "Jones", "Mary", "Jones", "Mary", "Jones", "JONES"]
    new, n = pii.rewrite(text, {}, KEY)
    assert n == 7 and "Mary" not in new and not re.search(r"\b(Jones|JONES)\b", new)
    # What a title or another mention tells.
    assert {x[2] for x in named("Dr. Alex Kim and Ms. Alex Kim, Dr. Alex")} == {"f LATIN alex", "n LATIN kim"}
    assert [x[2] for x in named("Frau Prof. Dr. Berger")] == ["n LATIN berger"]
    mail = named("Mr. Smith and Smith@mail.example, Smith.")
    assert len(mail) == 2 and [x[2] for x in pii.mentions("Mr. Smith and Smith@mail.example")] == ["surname", "email"]


@pytest.mark.parametrize(
    "text, parts",
    [
        ("Mr. John Paul Smith spoke", ["given John", "given Paul", "surname Smith"]),
        ("by Hans von Berg and", ["given Hans", "surname Berg"]),
        ("María de la Cruz García, Sra. Cruz", ["given María", "surname Cruz", "surname García", "surname Cruz"]),
        ("Mr. J. R. Smith, Mr. J.R. Smith", ["initial J", "initial R", "surname Smith"] * 2),
        ("John F. Kennedy's and", ["given John", "initial F", "surname Kennedy"]),
        ("Mr. John Smith Jr. and Mary Jones The", ["given John", "surname Smith", "given Mary", "surname Jones"]),
        ("Mary said that Mr. and Don't, Hans von hier", []),
        ("Pierre d'Artagnan I", ["given Pierre", "surname d'Artagnan"]),
    ],
)
def test_all_words_of_a_name(text, parts):
    assert [f"{kind} {value}" for value, kind, _ in named(text)] == parts
    new = pii.rewrite(text, {}, KEY)[0]
    assert all(not re.search(rf"\b{x.split()[1]}\b", new) for x in parts if x[0] != "i")


@pytest.mark.parametrize(
    "value, kind",
    [(x, "ipv6") for x in ("2001:db8::1", "fe80::1", "::ffff:10.1.2.3", "2001:DB8:0:0:0:0:0:1")]
    + [(x, "phone") for x in ("+33 1 23 45 67 89", "+33 6 12 34 56 78", "+61 2 9374 4000", "+49 (0)30 1234567", "+1 (957) 555-9688")]
    + [(x, "surname") for x in ("王小明", "محمد", "כהן", "शर्मा")]
    + [(x, None) for x in ("std::vector", "a::b::zz", "12:30:45", "::1", "+12 34", "+12345678901234567")],
)
def test_usual_forms_are_found(value, kind):
    text = f"Mr. {value}, and" if kind == "surname" else f"at {value}, and"
    found = [(text[a:b], k) for a, b, k, _ in pii.mentions(text)]
    assert found == ([(value, kind)] if kind else [])
    new = pii.rewrite(text, {}, KEY)[0]
    assert (value in new) == (kind is None)
    if kind:
        again = pii.mentions(new)
        assert [x[2] for x in again] == [kind]
    if kind == "surname":
        assert pii._script(new[4:]) == pii._script(value) != "LATIN"
    if value == "+49 (0)30 1234567":
        assert new.startswith("at +49 (0)") and pii.mentions(f"{value} +49 30 1234567")[1][3] == "49301234567"


def test_collisions_are_settled(spark):
    # Two-digit addresses of one form have few surrogates, so that many collide at first.
    entities = [("email", f"{a}{b}@x.example") for a in "abcdefghij" for b in range(10)]
    df = spark.createDataFrame(entities, "kind string, norm string")
    attempts = {(r.kind, r.norm): r.attempt for r in pii.settle(df, KEY).collect()}
    new = [pii.surrogate(k, n, attempts.get((k, n), 0), KEY) for k, n in entities]
    assert attempts and len(set(new)) == len(entities) and not set(new) & {n for _, n in entities}


def test_licenses_against_brute_force(spark, sf_dir):
    notice = "this program is free software you can redistribute it and or modify it under the terms of the GNU General Public License "
    notice += "as published by the Free Software Foundation either version 3 of the "
    rows = [(-1, "x " * 70 + notice + "y " * 9), (-2, None), (-3, ""), (-4, "RELEASED under the MIT license"), (-5, "Released under a MIT License"),
            (None, "Licensed under CC BY-NC 4.0"), (-6, "licensed " * 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").union(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    got = {(r.doc_id, r.license): (r.containment, r.first_word) for r in licenses.scan(docs, licenses.template_table(spark)).collect()}
    cut = regex.compile(r"[\p{L}\p{N}]+")

    def made(w):
        return {" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    want = {}
    for r in docs.collect():
        w = cut.findall((r.text or "").lower())
        for name, text in licenses.TEMPLATES:
            t = cut.findall(text.lower())
            width, stride = licenses.window_of(len(t))
            for s in range(0, len(w), stride) if made(w) & made(t) else ():
                share = len(made(t) & made(w[s : s + width])) / len(made(t))
                if share >= licenses.CONTAINMENT:
                    old = want.get((r.doc_id, name), (0, s))
                    want[r.doc_id, name] = (max(share, old[0]), min(s, old[1]))
    assert got == want and (-1, "GPL-3.0") in got and (-4, "MIT") in got and (None, "CC-BY-NC-4.0") in got
    assert all(licenses.least_similarity(n) >= 0.25 for n in range(5, 300))
    assert licenses.scan(docs.limit(0), licenses.template_table(spark)).count() == 0
    assert licenses.scan(docs, licenses.template_table(spark).limit(0)).count() == 0


def hits(text, items):
    cut = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

    def words(t):
        return cut.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))

    w, places, ids = words(text), set(), set()
    for item_id, item in items:
        t = words(item)
        k = min(13, len(t))
        grams = {tuple(t[i : i + k]) for i in range(len(t) - k + 1)} if k else set()
        for i in range(len(w) - k + 1) if k else ():
            if tuple(w[i : i + k]) in grams:
                places |= set(range(i, i + k))
                ids.add("-" if item_id is None else str(item_id))
    return len(w), len(places), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()


def test_decontamination_against_brute_force(spark):
    random.seed(7)
    some = "the of and a Éa b9 zug über x1 y2 z3 w4 v5 u6 t7".split()
    items = [(i, " ".join(random.choices(some, k=n))) for i, n in enumerate([1, 2, 5, 12, 13, 14, 30, 60])]
    items += [(0, "Short one"), (None, "no id at all"), (50, None), (51, "..."), (6, items[6][1]), (52, "the " * 20)]
    texts = [" ".join(random.choices(some, k=n)) for n in (0, 1, 5, 40, 400)] + [None, "", "?!", "the " * 50]
    for _, item in items:
        if item:
            texts.append("q " * 20 + item.upper().replace("É", "É") + " r" * 9)
            texts.append(" ".join(item.split()[:13]) + ".r " + item)
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)] + [(None, texts[9], 1)] * 2, "doc_id long, text string, key int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontam.contamination(docs, bench).collect()
    assert len(got) == docs.count()
    for r in got:
        want = hits(texts[9 if r.doc_id is None else r.doc_id], items)
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256) == want, r.doc_id
        assert r.contaminated == (want[1] > 0 and 20 * want[1] >= want[0])
    bad = sum(r.contaminated for r in got)
    kept = decontam.keep_clean(docs, bench)
    assert kept.columns == docs.columns and kept.count() == len(got) - bad
    assert decontam.contamination(docs.limit(0), bench).count() == 0
    assert not any(r.contaminated for r in decontam.contamination(docs, bench.limit(0)).collect())


def test_proximity_finds_what_exact_search_does_not(spark):
    item = [(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu")]
    near = item[0][1].replace("zeta", "zeta and").replace("mu", "very mu")
    docs = spark.createDataFrame([(1, near), (2, "alpha " + "x " * 50 + "nu"), (3, item[0][1])], "doc_id long, text string")
    items = decontam.item_table(spark.createDataFrame(item, "item_id long, text string"), 13)
    index = decontam.build_index(docs, items.selectExpr("explode(words) word").selectExpr("xxhash64(word) term").distinct())
    chosen = decontam.anchors(items, index)
    keys = {bytes(r.key): r.doc_id for r in index.where("term = 0").collect()}
    judged = decontam.contamination(docs, spark.createDataFrame(item, "item_id long, text string")).collect()
    assert {r.doc_id for r in judged if r.n_hit} == {3}
    assert {keys[bytes(r.key)] for r in decontam.proximity(index, chosen, 3).collect()} == {1, 3}


def near_by_brute_force(text, words, chosen, slack):
    w = decontam_words(text)
    hits = [(at, p) for at in chosen for p, x in enumerate(w) if x == words[at]]
    if min(13, len(words)) == 1:
        return bool(hits)
    return any(i != j and p != q and abs((p - i) - (q - j)) <= slack for i, p in hits for j, q in hits)


def decontam_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").lower())


@pytest.mark.parametrize("slack", [0, 1, 3])
def test_proximity_against_brute_force(spark, slack):
    random.seed(slack)
    rare = [f"w{i}" for i in range(9)]
    items = [(1, "w0 w1 w2 w3"), (2, "w4"), (3, "w5 w6 w5 w7"), (4, " ".join(random.choices(rare, k=17))), (None, "w8 w8")]
    # One chosen word only; a place between two that meet, and far from both.
    texts = ["w0", "w5 " + "x " * 9, "w8", "w4", None, "", "w0 w1 w2 w3", "w1 " + "x " * 30 + "w0 x x x w3 x x w2 " + "x " * 30 + "w1"]
    for n in (3, 8, 20):
        texts += [" ".join(random.choices([*rare, *["x"] * n], k=3 * n)) for _ in range(12)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(None, texts[6])], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    table = decontam.item_table(bench, 13)
    index = decontam.build_index(docs, table.selectExpr("explode(words) word").selectExpr("xxhash64(word) term").distinct())
    places = {}
    for r in decontam.anchors(table, index).join(table, "item").collect():
        places.setdefault((r.item_id, tuple(r.words)), set()).add(r.at)
    got = decontam.near_items(docs, bench, 13, slack).collect()
    assert len(got) == len(texts) + 1
    exact = {r.doc_id: r.n_items for r in decontam.contamination(docs, bench).collect()}
    for r in got:
        text = texts[6 if r.doc_id is None else r.doc_id]
        want = {i for (i, words), at in places.items() if near_by_brute_force(text, words, at, slack)}
        assert r.n_near == len(want) and r.n_near >= exact[r.doc_id], (text, want)
    by = {r.doc_id: r.n_near for r in got}
    assert [by[i] for i in range(7)] == [0, 0, 0, 1, 0, 0, 1]


def test_quality_of_the_held_out_fold(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = quality.classify(docs, labels)
    assert scored.count() == docs.count() and scored.where("score is null or score < 0 or score > 1").count() == 0
    told = scored.where("held_out").join(labels, "doc_id").selectExpr("avg(cast(predicted = quality as int)) right").first()
    assert told.right >= 0.95
    # What the held-out labels say changes nothing.
    other = labels.withColumn("quality", (1 - labels.quality)).where(quality.held_out()).union(labels.where(~quality.held_out()))
    a, b = (quality.classify(docs, x).orderBy("doc_id").collect() for x in (labels, other))
    assert np.allclose([r.score for r in a], [r.score for r in b])


def test_quality_of_odd_rows(spark):
    rows = [(i % 9 if i % 5 else None, t, i) for i, t in enumerate(ODD * 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, score int")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    one = spark.createDataFrame([(1, 1, 0), (2, 1, None), (None, 0, 0), (3, None, 0), (4, 7, 0)], "doc_id long, quality int, toxic int")
    for labels in (none, one):
        got = quality.classify(df, labels).collect()
        assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert quality.classify(df.limit(0), one).count() == 0
    assert quality.keep_good(df, none).columns == df.columns


def test_attribution_of_repeated_ids(spark):
    df = spark.createDataFrame([(1, "one two\nthree four"), (1, "one two\nthree four"), (1, "five\nsix seven eight nine ten")], "doc_id long, text string")
    got = tokens.by_kind(tokens.attribute(df, RANKS, PATTERN, "most", tokens.line_sections)).collect()
    assert len(got) == 6 and all(r.parts == 1 for r in got)
    whole = sorted(len(bpe.Encoder(RANKS, PATTERN).encode([r.text])[0]) for r in df.collect())
    by_part = {p: sorted((r.n_tokens, r.tokens) for r in got if r.part == p) for p in ("head", "body")}
    assert [n for n, _ in by_part["head"]] == [n for n, _ in by_part["body"]] == whole
    assert sorted(n for n, _ in by_part["head"]) == whole and sum(r.tokens for r in got) == sum(whole)


@pytest.mark.parametrize("text", [" " * 5_000_000 + "x", "ab" + "a" * 2_000_000, "\n" * 1_000_000])
def test_very_long_runs(text):
    starts, ends = tokens.token_spans(text, RANKS, PATTERN)
    assert starts[0] == 0 and ends[-1] == len(text) and (starts[1:] == ends[:-1]).all()
    ids = bpe.encoder(RANKS, PATTERN).encode([text])[0]
    assert bpe.vocabulary(RANKS).decode(ids) == text.encode()


def test_hits_of_many_items_in_one_text_equal_brute_force(spark):
    r = random.Random(4)

    def some(n):
        return [r.choice(["a", "b", "c", "long", "word"]) for _ in range(n)]

    shared = some(30)
    items = [("one", ["a"]), ("two", ["b", "c"])] + [(f"s{i}", some(3) + shared + some(3)) for i in range(20)]
    items += [(f"i{i}", some(r.randint(1, 20))) for i in range(20)]
    docs = [some(40) + shared[:14] + some(5) + shared + some(200), shared[:12], shared, some(3), []] + [some(60)] * 3
    got = decontam.contamination(
        spark.createDataFrame([(i, " ".join(d)) for i, d in enumerate(docs)], "doc_id long, text string"),
        spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id string, text string"),
    )
    want = {}
    for i, doc in enumerate(docs):
        hit, ids = set(), set()
        for item, w in items:
            k = min(13, len(w))
            windows = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)}
            at = [j for j in range(len(doc) - k + 1) if tuple(doc[j : j + k]) in windows]
            hit.update(p for j in at for p in range(j, j + k))
            ids.update([item] if at else [])
        digest = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        want[i] = (len(doc), len(hit), len(ids), digest, bool(hit) and 20 * len(hit) >= len(doc))
    rows = got.collect()
    assert len(rows) == len(docs)
    assert {x.doc_id: (x.n_words, x.n_hit, x.n_items, x.items_sha256, x.contaminated) for x in rows} == want
