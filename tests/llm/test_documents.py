"""Language, fingerprints, line chunks, near-duplicates, scores and the pipeline on small inputs."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tripmill.llm import fingerprint, language, line_chunks, minhash, scoring
from tripmill.llm.common import components, frequent

SF_DIR = "/root/testdata/sf0.001"


def some_words(rng, n):
    return ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n)]


# Components


def smallest_reachable(pairs):
    root = {n: n for p in pairs for n in p}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in pairs:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    return {n: find(n) for n in root}


@pytest.mark.parametrize("kind", ["chain", "star", "random", "none"])
def test_components(spark, kind):
    rng = random.Random(2)
    pairs = {
        "chain": [(i, i + 1) for i in range(60)] + [(200, 201), (201, 200)],
        "star": [(500, i) for i in range(80)],
        "random": [(rng.randint(0, 150), rng.randint(0, 150)) for _ in range(90)],
        "none": [],
    }[kind]
    got = components(spark.createDataFrame(pairs, "a long, b long"), "test").collect()
    wanted = {n: c for n, c in smallest_reachable(pairs).items() if any(n in p and p[0] != p[1] for p in pairs)}
    assert len(got) == len(wanted) and {r.node: r.component for r in got} == wanted


@pytest.mark.parametrize("most", [0, 1, 30, 250, 1000])
def test_frequent_uses_its_whole_budget(spark, most):
    """Ties at the edge are cut by hash, and counts above 65,536 are told apart."""
    rows = [(i, 3, 70_000 + i) for i in range(20)] + [(i, 4, 2) for i in range(20, 320)]
    counts = spark.createDataFrame(rows, "a long, b long, n long")
    got = {tuple(r) for r in frequent(counts, most).collect()}
    assert len(got) == min(most, 320) and got == {tuple(r) for r in frequent(counts.repartition(3), most).collect()}
    assert sorted((r[2] for r in got), reverse=True) == sorted((r[2] for r in rows), reverse=True)[:most]


# Language


def test_language_of_held_out_documents(spark):
    rows = language.op2_language_id(spark, SF_DIR).collect()
    docs = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 for r in rows)
    assert sum(docs[r.doc_id] == r.lang_pred for r in held) >= 0.95 * len(held)


def test_language_of_odd_texts(documents, odd_rows):
    docs = documents(odd_rows)
    rows = language.predict(docs, language.trained_on(docs)).collect()
    assert len(rows) == len(odd_rows)
    letters = {3: False, 4: False, 6: False, 7: False}
    for r in rows:
        told = r.text is not None and letters.get(r.doc_id, True)
        assert (r.lang_pred != "und") == told and (told or r.score == 0.0)
        assert r.label == "x" and r.part == 1
    nothing = documents([])
    model = language.trained_on(nothing)
    assert language.predict(nothing, model).count() == 0
    assert {r.lang_pred for r in language.predict(docs, model).collect()} == {"und"}


def test_numerals_and_marks_are_no_letters(documents):
    rows = [(0, "the same words in english", "en"), (4, "ein paar deutsche worte", "de"), (8, "noch mehr worte", "de"), (11, "more words", "en")]
    odd = ["\u00bd", "\u00b2\u00b3", "\u2160\u2177 12", "\u2460\u2461", "\u3007", "12_3", "\u0301 !"]
    docs = documents([*rows, *((100 + i, t, None) for i, t in enumerate(odd)), (200, "\u4e2d", None), (201, "\u00bd\u00e9", None)])
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.predict(docs, language.trained_on(docs)).collect()}
    assert all(got[100 + i] == ("und", 0.0) for i in range(len(odd)))
    assert got[200][0] != "und" and got[201][0] != "und"


def test_too_many_languages_are_refused(documents, monkeypatch):
    monkeypatch.setattr(language, "MOST_LANGUAGES", 3)
    language.trained_on(documents([(4 * i, "some text", f"l{i % 3}") for i in range(8)]))
    with pytest.raises(ValueError, match="not a column of languages"):
        language.trained_on(documents([(4 * i, "some text", f"l{i}") for i in range(8)]))


def reference_model(texts, labels, classes, kept_apart):
    """Inverse document frequencies, weights and temperature from dictionaries, a number at a time."""
    grams = [Counter(language.buckets_of(t).tolist()) for t in texts]
    seen = Counter(f for g in grams for f in g)
    idf = {f: math.log((1 + len(texts)) / (1 + n)) + 1 for f, n in seen.items()}
    vectors = []
    for g in grams:
        raw = {f: math.log(1 + n) * idf[f] for f, n in g.items()}
        length = math.sqrt(sum(v * v for v in raw.values()))
        vectors.append({f: v / length for f, v in raw.items()})
    z, n = Counter(), Counter()

    def weight(f, c):
        here = z[f, c]
        if abs(here) <= language.L1:
            return 0.0
        pull = (language.BETA + math.sqrt(n[f, c])) / language.ALPHA + language.L2
        return -(here - math.copysign(language.L1, here)) / pull

    def chances(scores):
        top = [math.exp(s - max(scores)) for s in scores]
        return [t / sum(top) for t in top]

    def scores(v):
        return [sum(x * weight(f, c) for f, x in v.items()) for c in range(classes)]

    for _ in range(language.EPOCHS):
        for i, (v, label) in enumerate(zip(vectors, labels, strict=True)):
            if i in kept_apart:
                continue
            p = chances(scores(v))
            before = {(f, c): weight(f, c) for f in v for c in range(classes)}
            for (f, c), w in before.items():
                gradient = v[f] * (p[c] - (c == label))
                step = (math.sqrt(n[f, c] + gradient**2) - math.sqrt(n[f, c])) / language.ALPHA
                z[f, c] += gradient - step * w
                n[f, c] += gradient**2
    held = [(scores(vectors[i]), labels[i]) for i in sorted(kept_apart)]
    loss = lambda t: -sum(math.log(chances([s / t for s in own])[label]) for own, label in held)
    best = min(np.geomspace(0.05, 5, 93).tolist(), key=loss)
    return [chances([s / best for s in scores(v)]) for v in vectors]


def test_model_equals_a_reference_by_numbers(documents):
    rng = random.Random(6)
    rows = [(i, " ".join(some_words(rng, 6)) + " " + "xyz"[i % 3] * 5, "abc"[i % 3]) for i in range(60)]
    docs = documents(rows)
    model = language.train(docs.select("doc_id", "text", "lang"))
    # The order in which the sample is learned is that of its rows' hashes.
    place = F.xxhash64(F.lit("language sample"), "doc_id", "text").alias("place")
    order = [r.doc_id for r in docs.select("doc_id", place).orderBy("place").collect()]
    texts, labels = [rows[i][1] for i in order], ["abc".index(rows[i][2]) for i in order]
    wanted = reference_model(texts, labels, 3, {i for i in range(60) if i % 5 == 4})
    for text, chances in zip(texts, wanted, strict=True):
        name, score = model.predict(text)
        assert score == pytest.approx(max(chances), rel=1e-4) and name == "abc"[chances.index(max(chances))]


def test_ftrl_separates_and_drops_weights():
    rng = np.random.default_rng(0)
    examples = []
    for i in range(300):
        label = i % 3
        found = np.sort(rng.choice(np.arange(40, 90), 6, replace=False))
        found = np.concatenate([[label * 10 + int(rng.integers(0, 5))], found])
        examples.append((found, np.full(7, 7**-0.5), label))
    weights = language.ftrl(examples, 3)
    assert all((v @ weights[f]).argmax() == label for f, v, label in examples)
    assert (weights != 0).mean() < 0.01


# Fingerprints


def test_fingerprints_follow_content(spark):
    rng = random.Random(4)
    text = " ".join(some_words(rng, 2000))
    data = text.encode()
    ends = fingerprint.chunk_ends(data)
    sizes = np.diff([0, *ends])
    assert ends[-1] == len(data) and sizes.max() <= fingerprint.LARGEST and sizes[:-1].min() >= fingerprint.SMALLEST
    whole = fingerprint.chunks(data)
    shifted = fingerprint.chunks(b"some words in front " + data)
    assert fingerprint.likeness(whole, shifted) > 0.95
    half = fingerprint.chunks(data[: len(data) // 2])
    assert fingerprint.likeness(half, whole) > 0.95 and 0.4 < fingerprint.likeness(whole, half) < 0.6
    assert fingerprint.likeness(whole, fingerprint.chunks(" ".join(some_words(rng, 2000)).encode())) < 0.05
    assert fingerprint.chunks(b"") == {} and fingerprint.likeness({}, {}) == 1.0


def ordered(rows):
    return sorted(((i, t or "") for i, t, _ in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))


@pytest.mark.parametrize("which", ["odd", "given", "one", "null ids", "ties"])
def test_next_document(spark, documents, odd_rows, which):
    rows = {
        "odd": odd_rows,
        "given": [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()],
        "one": [(7, "only one text here", "en")],
        "null ids": [(None, "b text", "en"), (None, "a text", "en")],
        "ties": [(5, f"text {i:03d} of the same id", "en") for i in range(50)] + [(6, "six", "en")],
    }[which]
    got = fingerprint.compare_with_next(documents(rows)).collect()
    wanted = ordered(rows)
    changed = []
    for n, (i, text) in enumerate(wanted):
        following = wanted[(n + 1) % len(wanted)][1]
        k = len(text) // 4
        new = text[: len(text) - k] + following[:k]
        prints = [fingerprint.chunks(t.encode()) for t in (text, new, following)]
        near = fingerprint.likeness(prints[0], prints[1]), fingerprint.likeness(prints[0], prints[2])
        changed.append((i, len(text), new, *map(fingerprint.fingerprint, prints[:2]), *near))
    assert Counter(tuple(r) for r in got) == Counter(changed)


def test_next_document_of_nothing(documents):
    assert fingerprint.compare_with_next(documents([])).count() == 0


# Line chunks


def stretches(text, size):
    """Every stretch of ``size`` words of a text, from its first word to the end of its last, with its place."""
    words = [m.span() for m in re.finditer(r"[^\x20\x09-\x0d]+", text or "")]
    return [(i, text[words[i][0] : words[i + size - 1][1]]) for i in range(len(words) - size + 1)]


def without_repeats(rows, size=line_chunks.PASSAGE_LINES):
    """Brute force: words in a stretch of ``size`` that stands at an earlier place go, with the white space behind them."""
    first, result = {}, []
    for i, text, _ in sorted(rows, key=lambda r: r[0]):
        for at, part in stretches(text, size):
            first.setdefault(part, (i, at))
    for i, text, _ in sorted(rows, key=lambda r: r[0]):
        starts = [m.start() for m in re.finditer(r"[^\x20\x09-\x0d]+", text or "")]
        gone = {at + k for at, part in stretches(text, size) if first[part] != (i, at) for k in range(size)}
        ends = [*starts[1:], len(text or "")]
        kept = (text or "")[: starts[0] if starts else None]
        kept += "".join(text[a:b] for n, (a, b) in enumerate(zip(starts, ends, strict=False)) if n not in gone)
        runs = sum(n in gone and n - 1 not in gone for n in range(len(starts)))
        result.append((i, None if text is None else kept if starts else text, runs))
    return result


def test_repeated_passages_go(documents):
    rng = random.Random(8)
    sentence = lambda n: " ".join(some_words(rng, n)) + "."
    passage = " ".join(sentence(9) for _ in range(7))
    several = "\n".join(sentence(10) for _ in range(6))
    rows = []
    for i in range(40):
        lines = [sentence(rng.randint(4, 14)) for _ in range(rng.randint(1, 9))]
        if i % 3 == 0:
            lines.insert(rng.randint(0, len(lines)), passage)
        if i % 4 == 0:
            lines.insert(rng.randint(0, len(lines)), several)
        rows.append((i, "\n".join(lines), "en"))
    got = line_chunks.without_repeated_chunks(documents(rows)).collect()
    assert sorted((r.doc_id, r.text, r.removed_chunks) for r in got) == without_repeats(rows)
    texts = {r.doc_id: r.text for r in got}
    assert passage in texts[0] and all(passage not in texts[i] for i in range(3, 40, 3))
    for i, text, _ in rows:
        if i % 3 and i % 4:
            assert texts[i] == text
    assert all(r.removed == "r" and r.part == 1 for r in got)


@pytest.mark.parametrize("joint", ["\n", " "])
def test_whole_passages_go_wherever_they_stand(documents, joint):
    """Sixty words on three to ten lines, or as sentences or plain words within a longer line, go as a whole."""
    rng = random.Random(10)
    made = lambda n, end=".": " ".join(some_words(rng, n)) + end
    rows, wanted = [], []
    for k in (3, 4, 6, 8, 10, 1):
        passage = joint.join(made(60 // k, "" if k == 1 and joint == " " else ".") for _ in range(k))
        glue = " " if k == 1 and joint == " " else joint
        for copy in range(3):
            around = [joint.join(made(9, "" if glue != joint or k == 1 else ".") for _ in range(7)) for _ in range(2)]
            rows.append((len(rows), f"{around[0]}{glue}{passage}{glue}{around[1]}", "en"))
            wanted.append(rows[-1][1].replace(passage + glue, "") if copy else rows[-1][1])
    got = line_chunks.without_repeated_chunks(documents(rows)).orderBy("doc_id").collect()
    assert [r.text for r in got] == wanted
    assert [r.removed_chars for r in got] == [len(t) - len(w) for (_, t, _), w in zip(rows, wanted, strict=True)]


def test_line_chunks_of_odd_texts(documents, odd_rows):
    got = line_chunks.without_repeated_chunks(documents(odd_rows)).collect()
    assert len(got) == len(odd_rows)
    before = Counter((i, t) for i, t, _ in odd_rows)
    after = Counter((r.doc_id, r.text) for r in got)
    # The second document repeats the first, whose two rows are one document; all else stays.
    assert (before - after) == Counter([(2, odd_rows[0][1])]) and sum(r.removed_chunks for r in got) == 1
    assert line_chunks.without_repeated_chunks(documents([])).count() == 0


def test_line_chunks_of_given_documents(spark):
    """Whatever goes stands at an earlier place, in stretches of a chunk's size; hardly anything repeated stays."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = [(r.doc_id, r.text, r.lang) for r in docs.collect()]
    got = {r.doc_id: r for r in line_chunks.op5_line_chunks(spark, SF_DIR).collect()}
    assert len(got) == len(rows)
    size, first = line_chunks.CHUNK_LINES, {}
    for i, text, _ in sorted(rows):
        for at, part in stretches(text, size):
            first.setdefault(part, (i, at))
    removed, repeated, lost = 0, Counter(), Counter()
    where = {}
    for i, text, _ in sorted(rows):
        for at, part in stretches(text, line_chunks.PASSAGE_LINES):
            where.setdefault(part, (i, at))
    most = {i: text for i, text, _ in without_repeats(rows, size)}
    least = {i: text for i, text, _ in without_repeats(rows)}
    for i, text, _ in rows:
        if text is None:
            assert got[i].text is None
            continue
        # No word goes that is in no stretch at an earlier place: what must stay is there, in order.
        left = iter(got[i].text.split())
        assert all(word in left for word in most[i].split()), i
        assert got[i].removed_chars == len(text) - len(got[i].text)
        removed += got[i].removed_chars
        apart = any(where[part][0] != i for _, part in stretches(text, line_chunks.PASSAGE_LINES))
        repeated[apart] += len(text) - len(least[i])
        lost[apart] += max(len(got[i].text) - len(least[i]), 0)
    # Of a text that repeats itself in circles more than one round may stay.
    assert removed > 0 and lost[True] <= 0.01 * repeated[True] and lost[False] <= 0.1 * repeated[False]


def test_a_passage_goes_from_lines_of_any_length(documents):
    """Neither the length of the line around it nor its own parting decides; a shorter passage stays everywhere."""
    rng = random.Random(4)
    long, short = " ".join(some_words(rng, 48)), " ".join(some_words(rng, 30))
    rows = []
    for n in (0, 1, 15, 19, 40):
        for passage in (long, short):
            around = [" ".join(some_words(rng, n)) for _ in range(2)]
            rows.append((len(rows), f"{' '.join(some_words(rng, 20))}.\n{around[0]} {passage} {around[1]}\nend {len(rows)}", "en"))
    got = {r.doc_id: r.text for r in line_chunks.without_repeated_chunks(documents(rows)).collect()}
    assert [i for i, t in got.items() if long in t] == [0]
    assert sorted(i for i, t in got.items() if short in t) == [1, 3, 5, 7, 9]
    assert sorted((i, t) for i, t in got.items()) == [(i, t) for i, t, _ in without_repeats(rows)]


def test_a_text_that_goes_round_in_circles(documents):
    rows = [(0, "one two three " * 4000, "en"), (1, "a line " * 3, "en"), (2, "start " + "one two three " * 40 + "end", "en")]
    got = {r.doc_id: r for r in line_chunks.without_repeated_chunks(documents(rows)).collect()}
    assert got[1].text == rows[1][1]
    assert got[0].text.startswith("one two three ") and len(got[0].text) < 1000
    assert got[2].text in ("start end", "start " + "one two three " + "end")
    assert len(line_chunks.chunk_places(rows[0][1].encode().split())[0]) <= 12_000 / line_chunks.CHUNK_LINES


def test_places_of_chunks_follow_content():
    rng = random.Random(2)
    passage = [w.encode() for w in some_words(rng, line_chunks.PASSAGE_LINES)]
    for _ in range(200):
        around = [[w.encode() for w in some_words(rng, rng.randint(0, 80))] for _ in range(4)]
        one, two = around[0] + passage + around[1], around[2] + passage + around[3]
        inside = []
        for lines, lead in ((one, len(around[0])), (two, len(around[2]))):
            places, hashes = line_chunks.chunk_places(lines)
            last = lead + len(passage) - line_chunks.CHUNK_LINES
            inside.append({(p - lead, h) for p, h in zip(places.tolist(), hashes.tolist(), strict=True) if lead <= p <= last})
        assert inside[0] & inside[1]


def test_repeated_lines_columns_and_rows(spark):
    """Columns with the module's own names stay; a crowded chunk is joined apart."""
    rng = random.Random(3)
    passage = " ".join(some_words(rng, 60))
    data = [(i, f"{i} words of its own here\n{passage}", i, "f", "n", 5, 6) for i in range(300)] + [(None, passage, 0, "f", "n", 5, 6)]
    docs = spark.createDataFrame(data, "doc_id int, text string, place int, `__found` string, n string, chunk int, removed_chunks int")
    got = line_chunks.without_repeated_chunks(docs).collect()
    assert got[0].asDict().keys() == {"doc_id", "text", "place", "__found", "n", "chunk", "removed_chunks", "removed_chars"}
    assert sorted(r.doc_id for r in got if r.doc_id is not None and r.removed_chunks == 0) == [0]
    assert all(r["__found"] == "f" and (r.doc_id in (0, None) or r.text == f"{r.doc_id} ") for r in got)
    assert len(got) == 301


# Near-duplicates


def near(rows, size, percent):
    """Brute force over all pairs; component of each doc_id."""
    sets = {}
    for i, text, _ in rows:
        words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[i] = {tuple(words[k : k + size]) for k in range(max(1, len(words) - size + 1))} if words else set()
    ids = sorted(sets)
    pairs = [(i, i) for i in ids]
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            same = len(sets[a] & sets[b])
            if same and 100 * same >= percent * (len(sets[a]) + len(sets[b]) - same):
                pairs.append((a, b))
    return sets, smallest_reachable(pairs)


def test_near_duplicates_equal_brute_force(documents):
    rng = random.Random(6)
    rows, number = [], 0
    common = some_words(rng, 60)
    for group in range(12):
        base = some_words(rng, rng.choice([3, 8, 40, 150]))
        if group % 3 == 0:
            base = common + base
        for _ in range(rng.choice([1, 2, 5, 25])):
            text = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 5])):
                text[rng.randrange(len(text))] = rng.choice(["new", "Other", "word"])
            rows.append((number, rng.choice([" ", "  ", "\n"]).join(text), "en"))
            number += 1
    rng.shuffle(rows)
    sets, groups = near(rows, 4, 80)
    got = minhash.near_duplicates(documents(rows), size=4).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == {
        i: (len(sets[i]), groups[i], groups[i] == i) for i in sets
    }


def test_blocks_of_a_large_bucket(documents, monkeypatch):
    """Pairs that no star finds are found in the blocks of their bucket."""
    monkeypatch.setattr(minhash, "BLOCK", 4)
    rng = random.Random(9)
    base = some_words(rng, 120)
    rows = []
    for i in range(40):  # a chain: each differs a little from the one before
        if i:
            base = list(base)
            base[(i * 7) % 120] = f"w{i}"
        rows.append((i, " ".join(base), "en"))
    sets, groups = near(rows, 4, 80)
    got = minhash.near_duplicates(documents(rows), size=4).collect()
    assert {r.doc_id: r.component_id for r in got} == groups


def test_near_duplicates_of_odd_texts(documents, odd_rows):
    got = minhash.near_duplicates(documents(odd_rows)).collect()
    assert len(got) == len(odd_rows)
    for r in got:
        assert r.component_id == {1: 1, 2: 1}.get(r.doc_id, r.doc_id)
        assert r.kept == (r.doc_id != 2) and (r.n_shingles > 0) == (r.doc_id not in (3, 4, 7) and r.n_shingles != 0)
    assert minhash.near_duplicates(documents([])).count() == 0


def test_estimate_is_corrected_for_chance():
    rng = np.random.default_rng(1)
    same = rng.random((400, minhash.MINIMA)) < 0.8
    a = rng.integers(0, 16, same.shape)
    b = np.where(same, a, rng.integers(0, 16, same.shape))
    pack = lambda m: np.frombuffer(b"".join(minhash.packed(r.astype(np.uint64)) for r in m), "<u8").reshape(len(m), -1)
    equal = minhash.equal_minima(pack(a), pack(b))
    assert (equal == (a == b).sum(axis=1)).all()
    assert abs(minhash.estimate(equal).mean() - 0.8) < 0.01
    assert (equal >= minhash.least_equal(80)).all()


# Scores


def test_scores_equal_counts_and_sum_to_one(spark, documents, odd_rows, monkeypatch):
    monkeypatch.setattr(scoring, "STRETCH", 7)
    monkeypatch.setattr(scoring, "LEXICON_WORDS", 60)
    rng = random.Random(3)
    words = some_words(rng, 80)
    texts = [" ".join(rng.choices(words, range(1, 81), k=rng.randint(0, 60))) for _ in range(60)]
    texts += [texts[0]] * 5
    docs = documents([*((i, t, "en") for i, t in enumerate(texts)), *((1000 + i, t, x) for i, (_, t, x) in enumerate(odd_rows))])
    train = docs.where("doc_id < 50").selectExpr("coalesce(text, '') AS text")
    model = scoring.LanguageModel(train)
    got = scoring.score(docs, model).collect()
    tokens = {}
    for r in docs.collect():
        tokens[r.doc_id] = [*re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), r.text or "")), None]
    counts = Counter(w for i, ws in tokens.items() if i < 50 for w in ws)
    total = sum(counts.values())
    for r in got:
        mine = tokens[r.doc_id]
        base = sum(math.log10((counts[w] + 1) / (total + len(counts) + 1)) for w in mine)
        assert (r.n_tokens, r.n_known) == (len(mine), sum(counts[w] > 0 for w in mine))
        assert r.base_score == pytest.approx(base, rel=1e-9)
    assert model.tokens == total
    # After any history the probabilities of all words and of an unseen one sum to one.
    vocabulary = [w for w in counts if w is not None]
    for history in ("", words[-1], f"{words[-1]} {words[-2]}", "neverseen"):
        rows = [(i, f"{history} {w}".strip(), "en") for i, w in enumerate([*vocabulary, "neverseen"])]
        rows += [(len(rows), history, "en")]
        ends = scoring.score(documents(rows), model).orderBy("doc_id").collect()
        # A text is a history, a word and the end: compare with two more ends to take the end's cost out.
        total_chance = 0.0
        for (_, text, _), r in zip(rows[:-1], ends, strict=False):
            total_chance += 10 ** (r.score - end_cost(model, text) - history_cost(documents, model, history))
        total_chance += 10 ** (ends[-1].score - history_cost(documents, model, history))
        assert total_chance == pytest.approx(1.0, abs=1e-6)


_COSTS: dict = {}


def walk(model, words):
    """Score by definition: step by step from the root, unseen words by their counts."""
    automaton = scoring._opened(model.name)
    counts = _COSTS.setdefault(id(model), {bytes(r.word): r.n for r in model.counts.collect()})
    state, costs = np.zeros(1, np.int64), []
    for w in words:
        number = model.number.get(w, -1)
        state, cost = automaton.step(state, np.array([number]))
        rare = math.log10((counts.get(w, 0) + 1) / model.outcomes) if number < 0 else 0.0
        costs.append(float(cost[0]) + rare)
    return costs


def end_cost(model, text):
    return walk(model, scoring.words_of(text))[-1]


def history_cost(documents, model, history):
    return sum(walk(model, scoring.words_of(history))[:-1])


def test_scores_do_not_depend_on_stretches(spark, documents, monkeypatch):
    rng = random.Random(5)
    words = some_words(rng, 30)
    texts = [" ".join(rng.choices(words, k=40)) for _ in range(30)] * 2
    docs = documents([(i, t, "en") for i, t in enumerate(texts)])
    model = scoring.LanguageModel(docs.select("text"))
    assert model.order == 3
    got = {r.doc_id: r.score for r in scoring.score(docs, model).collect()}
    for i, t in enumerate(texts[:10]):
        assert got[i] == pytest.approx(sum(walk(model, scoring.words_of(t))), abs=1e-9)
    nothing = documents([])
    empty = scoring.LanguageModel(nothing.select("text"))
    assert scoring.score(nothing, empty).count() == 0
    assert {r.score for r in scoring.score(docs, empty).collect()} == {0.0}


def by_definition(texts, train):
    """Trigram scores of ``texts`` by interpolated absolute discounting over all n-grams, without an automaton."""
    tokens = lambda t: [*t.lower().split(), None]
    counts = [Counter(tuple(ws[i : i + k]) for ws in map(tokens, train) for i in range(len(ws) - k + 1)) for k in (1, 2, 3)]
    total, distinct = sum(counts[0].values()), len(counts[0])

    def chance(gram):
        if len(gram) == 1:
            return (counts[0][gram] + 1) / (total + distinct + 1)
        n = counts[len(gram) - 1]
        ones, twos = (sum(v == x for v in n.values()) for x in (1, 2))
        off = ones / (ones + 2 * twos)
        kept = {g: v for g, v in n.items() if g[:-1] == gram[:-1] and v > 1}
        history = counts[len(gram) - 2][gram[:-1]]
        rest = 1 - sum(v - off for v in kept.values()) / history if kept else 1.0
        return (kept[gram] - off if gram in kept else 0) / max(history, 1) + rest * chance(gram[1:])

    return [sum(math.log10(chance(tuple(ws[max(0, i - 2) : i + 1]))) for i in range(len(ws))) for ws in map(tokens, texts)]


@pytest.mark.parametrize("bounds", [(1 << 17, 1 << 19), (10, 12), (0, 0)])
def test_scores_do_not_depend_on_bounds(spark, documents, monkeypatch, bounds):
    monkeypatch.setattr(scoring, "LEXICON_WORDS", bounds[0])
    monkeypatch.setattr(scoring, "ARCS", bounds[1])
    rng = random.Random(12)
    words = some_words(rng, 40)
    texts = [" ".join(rng.choices(words, range(1, 41), k=rng.randint(0, 30))) for _ in range(40)]
    docs = documents([(i, t, "en") for i, t in enumerate([*texts, "never seen " + texts[3]])])
    model = scoring.LanguageModel(docs.where("doc_id < 30").select("text"))
    got = [r.score for r in scoring.score(docs, model).orderBy("doc_id").collect()]
    assert got == pytest.approx(by_definition([*texts, "never seen " + texts[3]], texts[:30]), abs=1e-9)


# Pipeline


def test_pipeline_stages(spark, documents, odd_rows):
    docs = documents(odd_rows).select("doc_id", "text", "lang", "source", "n_chars")
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = corpus_pipeline.written(stage(spark, docs, SF_DIR), name)
        if name != "best_fit_packing":
            assert docs.columns == before.columns
    assert {r.doc_id for r in docs.collect()} == {1, 5, 8, 9, 10, None}


@pytest.mark.parametrize("labelled", [True, False])
def test_language_stage_keeps_every_document_with_a_letter(spark, documents, odd_rows, labelled):
    rows = [(i, t, f"l{i % 5}" if labelled else None) for i, t in enumerate(["the same words in all", "q"] * 20)]
    docs = documents([*rows, *((100 + (i or 0), t, None) for i, t, _ in odd_rows)])
    kept = [r.doc_id for r in corpus_pipeline.language_id(spark, docs, SF_DIR).collect()]
    assert sorted(kept) == [*range(40), 100, 101, 101, 102, 105, 108, 109, 110]


def test_pipeline_keeps_one_of_each_group(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    kept = corpus_pipeline.minhash_dedup(spark, docs, SF_DIR).collect()
    _, groups = near([(r.doc_id, r.text, r.lang) for r in docs.collect()], 5, 80)
    assert sorted(r.doc_id for r in kept) == sorted(set(groups.values()))
