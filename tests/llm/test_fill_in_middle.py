"""The piece table against a plain rearrangement of strings, and round trips."""

import hashlib
import random

from hypothesis import given, settings, strategies as st

from stayline.llm import fill_in_middle as M


def plain_form(doc, text):
    """(n, form, prefix, middle, output) by slicing strings."""
    h = hashlib.sha256(f"1:{'null' if doc is None else doc}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    n = len(text)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return n, "spm", a, b - a, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", a, b - a, f"<P>{prefix}<S>{suffix}<M>{middle}"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


TEXTS = [None, "", "a", "<", "<P", "S><M", "a<P>b", "é", "日本\n語🙂é", " \t\n", "<S<P<M>>", "x" * 200_000 + "ü"]


def test_every_row_against_strings(spark, documents):
    rows = [(i % 400 if i % 50 else None, TEXTS[i % len(TEXTS)]) for i in range(1_200)]
    got = sorted((tuple(r) for r in M.digests(documents(rows)).collect()), key=repr)
    want = []
    for doc, text in rows:
        n, form, prefix, middle, output = plain_form(doc, text or "")
        want.append((doc, n, form, prefix, middle, sha(output), sha(text or "")))
    assert got == sorted(want, key=repr)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}


def test_texts_and_their_way_back(spark, documents):
    rows = [(i, TEXTS[i % len(TEXTS)]) for i in range(300)]
    docs = documents(rows).withColumnRenamed("keep", "output").withColumnRenamed("d", "form")
    turned = M.rearranged(docs)
    assert turned.columns == [*docs.columns, "fim_form"]
    assert {r["doc_id"]: r["text"] for r in turned.collect()} == {d: plain_form(d, t or "")[4] for d, t in rows}
    back = M.put_back(turned)
    assert back.columns == docs.columns
    assert {r["doc_id"]: (r["text"], r["output"]) for r in back.collect()} == {d: (t or "", "k") for d, t in rows}


def test_an_empty_table(spark, documents):
    none = documents([(1, "a")]).where("false")
    assert M.digests(none).collect() == [] and M.put_back(M.rearranged(none)).collect() == []


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="<>PSMaé🙂", max_size=30), st.integers(0, 10_000))
def test_descriptors_bring_every_text_back(text, doc):
    data = text.encode()
    found = M.cut(data, f"1:{doc}".encode())
    output = M.joined(found.output, data)
    assert output.decode() == plain_form(doc, text)[4]
    assert M.joined(M.restored(output, found.form), output) == data
    assert M.digest(found.output, data) == sha(output.decode())


def test_split_at_and_between_descriptors():
    runs = [M.Descriptor(0, 2, 5), M.Descriptor(1, 0, 3), M.Descriptor(0, 7, 9)]
    width = lambda ds: sum(d.end - d.start for d in ds)
    for at in range(9):
        before, after = M.split(runs, at)
        assert width(before) == at and width(before) + width(after) == 8
    assert M.split(runs, 3) == (runs[:1], runs[1:])


def test_memory_is_not_copied_for_hashing():
    text = random.Random(1).randbytes(1_000)
    (view,) = M.streamed([M.Descriptor(0, 10, 900)], text)
    assert view.obj is text and view.nbytes == 890
