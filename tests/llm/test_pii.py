import hashlib
import random
import re

import numpy as np
import pytest

from vecquery.llm import pii, pii_model
from vecquery.llm.pii_patterns import KINDS, base_spans, is_card, is_ip, is_phone, listed, ordered


def plain(text):
    found = [(*m.span(), "email") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    found += [(*m.span(), "ip") for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if is_ip(m[0])]
    found += [(*m.span(), "card") for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if is_card(m[0])]
    found += [(*m.span(), "phone") for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if is_phone(m[0])]
    return ordered(found)


@pytest.fixture(scope="module")
def net():
    return pii_model.train(pii.examples(["the river ran under a stone bridge and boats came home in spring " * 5], 3_000), rounds=160)


def test_base_spans_equal_the_patterns():
    draw = random.Random(5)
    for _ in range(6_000):
        text = "".join(draw.choice("a@.1234567890 -+()%b\n") for _ in range(draw.randint(0, 70)))
        assert base_spans(text) == plain(text)
    assert base_spans("9" * 50_000 + "@" * 1_000 + "+" + " " * 50_000) == []


def test_gradients():
    net = pii_model.new_network(1)
    draw = np.random.default_rng(0)
    y = draw.integers(0, pii_model.TAGS, (6, 3))
    score = draw.normal(size=(6, 3, pii_model.TAGS))
    loss, dscore, dstep = pii_model._crf(score, net.step, y)
    for at in ((0, 1, 2), (5, 0, 3), (3, 2, 0)):
        bumped = score.copy()
        bumped[at] += 1e-6
        assert (pii_model._crf(bumped, net.step, y)[0] - loss) / 1e-6 == pytest.approx(dscore[at], abs=1e-4)
    step = net.step.copy()
    step[1, 0] += 1e-6
    assert (pii_model._crf(score, step, y)[0] - loss) / 1e-6 == pytest.approx(dstep[1, 0], abs=1e-4)


def test_finds_other_spellings(net):
    draw = random.Random(8)
    tagger = pii_model.Tagger(net)
    found = 0
    for n in range(120):
        kind = KINDS[n % 4]
        span = pii._span(draw, kind)
        text = f"boats came {span} home in spring"
        spans = pii.all_spans(text, tagger.tags([text])[0])[1]
        found += any(k == kind and a <= 11 and z >= 11 + len(span) for a, z, k in spans)
    assert found > 80


def test_windows_are_reconciled(net):
    """Any cut into windows gives the tags of one window over the whole text, but for far context."""
    draw = random.Random(2)
    text = " ".join(draw.choice([*"river stone bridge boat".split(), pii._span(draw, draw.choice(KINDS))]) for _ in range(120))
    tagger = pii_model.Tagger(net)
    whole = tagger.tags([text], core=100_000)[0]
    cut = tagger.tags([text, "", "a", text], core=64, margin=48)
    assert [len(c) for c in cut] == [len(text), 0, 1, len(text)]
    assert (cut[0] == cut[3]).all() and (cut[0] == whole).mean() > 0.995


def test_spans_at_every_offset_around_an_edge(net):
    """The production windows find and redact what one window over the whole text finds, wherever an edge cuts a span."""
    tagger = pii_model.Tagger(net)
    draw = random.Random(3)
    spans = [s for kind in KINDS for s in sorted({pii._span(draw, kind) for _ in range(40)}, key=len)[-2:]]
    spans += ["riverstone.bridgeboat [at] some-host [dot] mail [dot] com", "firstname.lastname (at) springhost (dot) mail (dot) org"]
    filler = "river stone bridge boat came home in spring "
    for span in spans:
        before = (filler * 20)[-(pii_model.CORE + 4) :]
        texts = [before[i:] + span + " " + filler * 14 for i in range(len(span) + 8)]
        for text, got, whole in zip(texts, tagger.tags(texts), tagger.tags(texts, core=100_000), strict=True):
            assert pii.all_spans(text, got)[1] == pii.all_spans(text, whole)[1]


def test_windows_that_nowhere_agree_are_decoded_as_one(net):
    tagger = pii_model.Tagger(net)
    text = ("riverstone.bridge [at] somehost [dot] mail [dot] com and " * 6)[:300]
    cut, whole = (tagger.tags([text], core=c, margin=4)[0] for c in (16, 100_000))
    assert len(cut) == len(whole) and (cut == whole).mean() > 0.5


def test_long_texts_in_sections(net, monkeypatch):
    tagger = pii_model.Tagger(net)
    draw = random.Random(6)
    text = " ".join(draw.choice([*"river stone bridge boat".split(), pii._span(draw, draw.choice(KINDS))]) for _ in range(900))
    whole = tagger.tags([text, "a"])
    monkeypatch.setattr(pii_model, "SECTION", 3)
    cut = tagger.tags([text, "a"])
    assert len(text) > 4 * 512 and (cut[0] == whole[0]).all() and len(cut[1]) == 1


def test_skipped_windows_are_all_o(net):
    draw = random.Random(4)
    texts = [" ".join(draw.choice([*"river stone bridge boat 12 3.5 v2".split(), pii._span(draw, draw.choice(KINDS))]) for _ in range(30)) for _ in range(20)]
    tagger, full = pii_model.Tagger(net), pii_model.Tagger(net)
    full._may_leave = lambda score, lengths, active: np.ones(len(lengths), dtype=bool)
    for a, b in zip(tagger.tags(texts), full.tags(texts), strict=True):
        assert (a == b).all()


def test_edges(spark, net, edge_docs, no_docs):
    got = pii.find(edge_docs, net).collect()
    assert len(got) == edge_docs.count() and {r["spans"] for r in got} == {""}
    assert {r["base_sha256"] for r in got} == {hashlib.sha256(b"").hexdigest()}
    assert pii.find(no_docs, net).count() == 0
    docs = spark.createDataFrame([(1, "mail a.b@c.de or 10.1.2.3 or +1 (499) 555-6503 x"), (2, None), (2, "4111 1111 1111 1111")], "doc_id bigint, text string")
    rows = {(r["doc_id"], r["spans"]): r for r in pii.find(docs, net).collect()}
    first = rows[1, "email:5:13,ip:17:25,phone:29:46"]
    assert (first["n_email"], first["n_ip"], first["n_card"], first["n_phone"]) == (1, 1, 0, 1)
    assert first["base_sha256"] == hashlib.sha256(listed(base_spans(docs.first()["text"])).encode()).hexdigest()
    assert (2, "") in rows and (2, "card:0:19") in rows
    red = docs.select("doc_id", pii.redacted_column(net).alias("t")).collect()
    assert [r["t"] for r in red] == ["mail [EMAIL] or [IP] or [PHONE] x", None, "[CARD]"]


def test_overlapping_spans_are_redacted_as_one():
    assert pii.redact_text("abcdefgh", [(1, 4, "email"), (2, 6, "phone"), (7, 8, "ip")]) == "a[EMAIL]g[IP]"


def test_training_without_texts(no_docs):
    assert len(pii.examples([], 50)) > 0 and pii.train_network(no_docs).table.shape[1] == pii_model.CODES
