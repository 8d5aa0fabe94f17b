"""Fill-in-middle against cuts by regular expression."""

import hashlib
import random
import re

import pytest

from tripmill.llm import fim

UNITS = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+").findall


def drawn(doc_id):
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]


def brute(doc_id, text):
    text = text or ""
    units, (h1, h2, h3, h4) = UNITS(text), drawn(doc_id)
    low, high = sorted(h % (len(units) + 1) for h in (h1, h2))
    prefix, middle, suffix = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= 50:
        return doc_id, len(units), "plain", None, None, text, text
    form = "spm" if h4 % 100 < 80 else "psm"
    output = f"<S>{suffix}<P>{prefix}<M>{middle}" if form == "spm" else f"<P>{prefix}<S>{suffix}<M>{middle}"
    return doc_id, len(units), form, len(prefix), len(middle), output, text


@pytest.mark.parametrize("largest", [5, 64, 4096])
def test_cuts_equal_the_units_of_a_regular_expression(monkeypatch, largest):
    monkeypatch.setattr(fim, "LARGEST", largest)
    rng, summaries = random.Random(largest), fim.Summaries()
    for _ in range(2000):
        text = "".join(rng.choices("ab \n\x0b\x1cé \U0001f600", k=rng.randint(0, 300)))
        units, draws = UNITS(text), (rng.randrange(1 << 32), rng.randrange(1 << 32))
        low, high = sorted(d % (len(units) + 1) for d in draws)
        wanted = len(units), len("".join(units[:low])), len("".join(units[low:high]))
        assert fim.cut(text.encode(), draws, summaries) == wanted


def test_chunks_follow_content_whatever_the_block(monkeypatch):
    rng = random.Random(3)
    data = "".join(rng.choices("abcdefgh \n", k=60_000)).encode()
    ends = fim.chunk_ends(data)
    assert ends[-1] == len(data) and ends == sorted(set(ends))
    assert max(b - a for a, b in zip([0, *ends], ends, strict=False)) <= fim.LARGEST
    shifted = fim.chunk_ends(b"some words in front " + data)
    parts = {data[a:b] for a, b in zip([0, *ends], ends, strict=False)}
    moved = b"some words in front " + data
    again = {moved[a:b] for a, b in zip([0, *shifted], shifted, strict=False)}
    assert len(parts & again) > 0.9 * len(parts)
    monkeypatch.setattr(fim, "_BLOCK", 1000)
    assert fim.chunk_ends(data) == ends
    assert fim.chunk_ends(b"") == []


def test_shared_chunks_are_summed_up_once(monkeypatch):
    made = []
    monkeypatch.setattr(fim, "summary", lambda chunk: made.append(chunk) or fim.Summary(1, True, True))
    summaries = fim.Summaries()
    for _ in range(3):
        summaries.of(b"one chunk")
    assert made == [b"one chunk"]
    monkeypatch.setattr(fim, "REMEMBERED", 300)  # set aside, and found there
    for i in range(3):
        summaries.of(b"%03d" % i + b"x" * 100)
    summaries.of(b"one chunk")
    assert made.count(b"one chunk") == 1


def test_odd_rows_and_marks(spark, documents, odd_rows):
    rng = random.Random(1)
    rows = [*odd_rows, *((100 + i, " ".join(rng.choices(["a", "<", "P>", "S", "é", "\n"], k=40)), "en") for i in range(60))]
    rows += [(200, "a <P> b", "en"), (201, "<S", "en"), (202, "<M>", "en"), (203, " ", "en")]
    done = fim.fill_in_middle(documents(rows))
    back = done.withColumn("back", fim.restored(done.output, done.form))
    got = back.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "back").collect()
    assert sorted(map(tuple, got), key=str) == sorted((brute(i, t) for i, t, _ in rows), key=str)
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    assert fim.fill_in_middle(documents([])).count() == 0


def test_shares_of_forms(spark, documents):
    rows = [(i, "some words in a row", "en") for i in range(400)]
    forms = [r.form for r in fim.fill_in_middle(documents(rows), percent=100, spm_percent=0).collect()]
    assert set(forms) == {"psm"}
    forms = [r.form for r in fim.fill_in_middle(documents(rows), percent=0).collect()]
    assert set(forms) == {"plain"}
