"""Base spans against the plain patterns, the chain field against labels it has not seen."""

import re
from hashlib import sha256

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from plugsites.llm import crf, pii
from plugsites.llm.labelled_forms import labelled_forms
from plugsites.llm.pii_rules import KINDS, base_spans, luhn

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, text):
    digits = re.sub("[^0-9]", "", text)
    if kind == "ip":
        return all(int(part) <= 255 for part in text.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 10 <= len(digits) <= 15


def plain_spans(text):
    found = []
    for number, kind in enumerate(KINDS):
        for match in re.finditer(PATTERNS[kind], text):
            if passes(kind, match.group()):
                found.append((match.start(), number, match.end()))
    return sorted(found)


AWKWARD = [
    "",
    "a@b.c@d.e x@y a@b..c %@q.w.e, a@b.c%x@d.e",
    "1.2.3.4.5.6.7.8 300.1.1.1 0255.1.1.001 1.2.3",
    "4111 1111 1111 1111 and 4111-1111-1111-1111 4111111111111112",
    "+1 (716) 555-8176, +49(0)30 123456 +1-2 ++12 3456 7890 1",
    "é 日本 user.name+tag@mail2.example.com \x1d 84.251.36.42",
    "1" * 3000 + "@" + "a." * 500 + "b",
]


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="0123456789.@+- ()ab%é_\n", max_size=60))
def test_spans_equal_plain_patterns(text):
    assert base_spans(text) == plain_spans(text)


def test_awkward_texts_and_long_runs_are_quick():
    for text in AWKWARD:
        assert base_spans(text) == plain_spans(text)
    for run in ("a" * 300_000, "1" * 300_000, "+1(" * 100_000, "1." * 150_000, "@a." * 100_000):
        base_spans(run)
        crf.chains(run)


def test_luhn():
    assert luhn("4111111111111111") and not luhn("4111111111111112")


def labelled(seed, n):
    draw = np.random.default_rng(seed)
    out = []
    for _ in range(n):
        octets = ".".join(str(x) for x in draw.integers(0, 256, 4))
        phone = "+1 ({}) 555-{}".format(draw.integers(200, 999), draw.integers(1000, 9999))
        name = "".join(draw.choice(list("abcdefg"), 6))
        mail = f"{name}.{draw.integers(10, 99)}@mail{draw.integers(0, 9)}.example.com"
        text = f"word {octets} other {phone} and {mail} version {draw.integers(1, 9)}.0 of {draw.integers(1900, 2030)}."
        out.append(text)
    return out


def sequences(texts):
    pairs = [(t, c) for t in texts for c in crf.chains(t)]
    return [crf.features(t, c) for t, c in pairs], [crf.gold(c, base_spans(t)) for t, c in pairs]


def test_field_reaches_held_out_accuracy_and_is_a_field():
    field = crf.train(*sequences(labelled(1, 150)))
    features, truth = sequences(labelled(2, 150))
    got = field.decode(features)
    right = sum(a == b for x, y in zip(got, truth) for a, b in zip(x, y))
    assert right / sum(map(len, truth)) > 0.97
    for path in got:  # no inside label without its begin
        for before, label in zip([0, *path], path):
            assert label == 0 or label % 2 or before in (label, label - 1)


def test_viterbi_equals_all_paths():
    import itertools

    field = crf.train(*sequences(labelled(3, 40)), rounds=20)
    for sequence in [s for s in sequences(labelled(4, 20))[0] if len(s) <= 3]:
        scores, _ = field.scores([sequence])
        best = max(
            itertools.product(range(crf.LABELS), repeat=len(sequence)),
            key=lambda p: field.start[p[0]]
            + sum(scores[t][label] for t, label in enumerate(p))
            + sum(field.move[a, b] for a, b in zip(p, p[1:])),
        )
        assert field.decode([sequence]) == [list(best)]


def test_field_adds_spans_that_the_rules_drop(spark):
    texts = labelled(5, 120) + ["call 300.1.2.3 now", None, "", "nothing here 12"]
    docs = spark.createDataFrame(
        [(k, t, "x") for k, t in enumerate(texts)], "doc_id long, text string, spans string"
    )
    field = pii.train_field(pii.labelled_chains(docs, at_most=300))
    rows = {r.doc_id: r for r in pii.find_personal_data(docs, field, masked=True).collect()}
    assert len(rows) == len(texts)
    for k, text in enumerate(texts):
        base = [(s.start, KINDS.index(s.kind), s.end) for s in rows[k].base]
        assert base == plain_spans(text or "")
        spans = [(s.start, KINDS.index(s.kind), s.end) for s in rows[k].spans]
        assert set(base) <= set(spans) and spans == sorted(spans)
    assert rows[len(texts) - 1].spans == []
    assert rows[0].masked.startswith("word [IP] other [PHONE] and [EMAIL] version ")
    assert pii.train_field(pii.labelled_chains(docs.limit(0))) is None
    assert pii.find_personal_data(docs.limit(0), None).count() == 0


def test_mask_keeps_all_columns(spark):
    docs = spark.createDataFrame(
        [(1, "a 1.2.3.4 b", "en", 11), (2, None, None, None), (None, "plain", "de", 5)],
        "doc_id long, text string, lang string, n_chars long",
    )
    rows = {tuple(r) for r in pii.mask_documents(docs, None).collect()}
    assert rows == {(1, "a [IP] b", "en", 8), (2, None, None, None), (None, "plain", "de", 5)}


def test_overlapping_spans_are_masked_once():
    assert pii.mask("ab12345cd", [(2, 2, 5), (3, 3, 7)]) == "ab[CARD]cd"


def test_query_equals_plain_patterns(spark, folder):
    from plugsites.llm.catalog import QUERIES

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = QUERIES["op1_personal_data"](spark, folder).collect()
    assert len(rows) == len(texts)
    for row in rows:
        base = plain_spans(texts[row.doc_id] or "")
        parts = [f"{KINDS[kind]}:{start}:{end}" for start, kind, end in base]
        assert row.base_sha256 == sha256(",".join(parts).encode()).hexdigest()
        counts = [sum(kind == k for _, kind, _ in base) for k in range(4)]
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == counts
        assert set(parts) <= set(row.spans.split(",")) or not parts


def found_share(field, rows):
    """(share of spans found, share of rows without any in which something is found)."""
    hit = spans = wrong = clean = 0
    for text, truth in rows:
        got = []
        for chain in crf.chains(text):
            (path,) = field.decode([crf.features(text, chain)])
            got += crf.predicted_spans(text, chain, path)
        spans += len(truth)
        hit += sum(any(a < end and start < b and k == kind for a, k, b in got) for start, kind, end in truth)
        clean += not truth
        wrong += bool(got) and not truth
    return hit / spans, wrong / clean


def test_field_finds_held_out_forms_that_the_rules_miss():
    held_out = labelled_forms(400, seed=77)
    assert labelled_forms(50) == labelled_forms(50) and not {t for t, _ in held_out} & {t for t, _ in labelled_forms()}
    missed = [row for row in held_out if row[1] and not base_spans(row[0])]
    assert len(missed) > 0.9 * sum(bool(spans) for _, spans in held_out)
    table = [(t, base_spans(t)) for t in labelled(1, 150)] + labelled_forms()
    pairs = [(t, c, spans) for t, spans in table for c in crf.chains(t)]
    field = crf.train([crf.features(t, c) for t, c, _ in pairs], [crf.gold(c, s) for _, c, s in pairs])
    recall, false = found_share(field, [row for row in held_out if row in missed or not row[1]])
    assert recall > 0.9 and false < 0.05, (recall, false)


def test_words_next_to_written_signs_are_in_the_chain():
    text = "please write to anna dot berg at mail dot org or come by"
    (chain,) = crf.chains(text)
    assert [text[a:b] for a, b in chain] == ["write", "to", "anna", "dot", "berg", "at", "mail", "dot", "org"]
    assert crf.chains("no sign here, look at it") == []
    text = "a b(at)c(dot)de f"
    assert [text[a:b] for c in crf.chains(text) for a, b in c] == ["a", "b(at)c(dot)de", "f"]
    assert len(crf.chains("dot " * 1000)) == 1


def test_labelled_chains_are_drawn_below_a_share(spark):
    docs = spark.createDataFrame([(k, f"n {k} and {k * 7}") for k in range(3000)], "doc_id long, text string")
    rows = pii.labelled_chains(docs.repartition(7), at_most=200)
    assert rows.count() == 200
    assert sorted(map(str, rows.collect())) == sorted(map(str, pii.labelled_chains(docs.coalesce(1), at_most=200).collect()))
    assert pii.labelled_chains(docs.limit(60), at_most=200).count() == 120


def test_long_texts_are_masked_in_portions(spark, monkeypatch):
    monkeypatch.setattr(pii, "PORTION_CHARS", 50)
    assert list(pii._rows_in_portions(["a" * 30, None, "b" * 30, "c" * 80, ""])) == [[0, 1], [2], [3], [4]]
    long = "word " * 200_000 + "9.9.9.9"
    docs = spark.createDataFrame([(1, long), (1, long), (2, "")], "doc_id long, text string")
    lengths = sorted(len(row.text) for row in pii.mask_documents(docs, None).collect())
    assert lengths == [0, 1_000_004, 1_000_004]
