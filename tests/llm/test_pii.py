import hashlib
import random
import re

import numpy as np
import pyarrow as pa

from strata.llm import boosting, pii


def task_rows(texts):
    """Labelled candidates as one task gives them."""
    batch, = pii._training(iter([pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])]))
    return sorted(zip(*(c.to_pylist() for c in batch.columns)), key=lambda r: r[:3])


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        value = int(c) * (1 + i % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def brute(text):
    """The four patterns as they are written, leftmost and not overlapping per kind."""
    found = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            found.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub(r"[\x20-]", "", m.group())
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


PARTS = ["a", "9", "12", "255", "256", "0001", ".", "@", "+", " ", "-", "(", ")", "é", "\n", "x.y@z.w", "4111 1111 1111 1111",
         "4111111111111111", "1.2.3.4", "+1 (620) 555-8424", 'token = "0123456789abcdef0123456789abcdef01234567"']


def texts(n, seed=1):
    rnd = random.Random(seed)
    return ["".join(rnd.choices(PARTS, k=rnd.randint(0, 14))) for _ in range(n)]


def test_base_spans_against_plain_patterns():
    for text in texts(20_000):
        assert pii.base_spans(text) == brute(text), text


def test_each_written_out_form_alone_in_a_text_is_a_candidate():
    spans = ["jane.doe@example.org", "10.20.30.40", "4111 1111 1111 1111", "+1 (620) 555-8424"]
    for kind, span in enumerate(spans):
        assert pii.base_spans(span) == [(0, kind, len(span))]
        for form in pii._written_out(kind, span):
            assert (0, kind, len(form)) in pii.candidates(form), form


def test_long_secrets_are_candidates_whole():
    for size in (20, 129, 2000):
        for part in ("a1B2", "a1+B", "a1/-B", "_x9"):
            token = (part * size)[:size - 1] + "z"
            assert (9, pii.KINDS.index("secret"), 9 + size) in pii.candidates(f'token = "{token}"'), (size, part)


def test_long_runs_are_linear():
    for run in ("1" * 200_000, "a" * 200_000, "a." * 100_000, "1." * 100_000, "+1" + "(" * 200_000, "1 " * 100_000, "@a" * 50_000):
        pii.base_spans(run)
        pii.candidates(run)


def test_spans_of_documents(documents, odd_rows):
    rows = odd_rows + [(1000 + i, t, "s") for i, t in enumerate(texts(400, 2))]
    text = {r[0]: r[1] or "" for r in rows}
    got = pii.personal_data(documents(rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            continue
        base = brute(text[r.doc_id])
        listed = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in base)
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == i for _, k, _ in base) for i in range(4)]
        spans = [s.split(":") for s in r.spans.split(",") if s]
        assert set(filter(None, listed.split(","))) <= set(r.spans.split(","))
        assert spans == sorted(spans, key=lambda s: (int(s[1]), pii.KINDS.index(s[0])))
    assert pii.personal_data(documents([])).count() == 0


def test_redaction_keeps_columns_and_nulls(documents):
    df = documents([(1, "mail a.b@c.org now"), (2, None), (3, "clean text")])
    got = {r.doc_id: r for r in pii.redact(df).collect()}
    assert pii.redact(df).schema == df.schema
    assert got[1].text == "mail <EMAIL> now" and got[2].text is None and got[3].text == "clean text"


def test_overlaps():
    base = [(2, 0, 5), (4, 1, 20), (30, 2, 31)]
    assert pii._apart([(0, 0, 2), (0, 0, 3), (19, 0, 22), (20, 0, 30), (31, 0, 33)], base) == \
        [(0, 0, 2), (20, 0, 30), (31, 0, 33)]
    assert pii._disjoint([(5, 0, 9), (8, 1, 12), (1, 0, 5), (9, 0, 10)]) == [(1, 0, 5), (5, 0, 9), (9, 0, 10)]
    assert pii.redact_text("0123456789", [(1, 0, 4), (3, 1, 6), (8, 2, 9)]) == "0<EMAIL>67<CARD>9"


def test_trees_on_held_out_rows():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(4000, 6))
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] * x[:, 2] > 0)).astype(float)
    held = np.arange(4000) % 4 == 3
    model = boosting.fit(x[~held], y[~held])
    right = (model.probability(x[held]) > 0.5) == y[held]
    assert right.mean() > 0.8
    threshold = boosting.calibrate(model, x[held], y[held], 0.95)
    passed = model.probability(x[held]) >= threshold
    assert passed.sum() > 50 and y[held][passed].mean() >= 0.95
    assert boosting.calibrate(model, x[:0], y[:0], 0.9) > 1


def test_added_spans_reach_their_precision_on_held_out_texts():
    """Assigned secrets and written-out numbers among plain words and failing numbers."""
    rnd = random.Random(11)

    def text():
        words = [rnd.choice(["lorem", "ipsum", "dolor", "amet"]) for _ in range(20)]
        kind = rnd.randrange(5)
        words[10] = ["a%d@mail.example.com" % rnd.randint(0, 99), "%016d" % rnd.randint(0, 10 ** 16),
                     'token = "%040x"' % rnd.getrandbits(160), "+1 (%03d) 555-%04d" % (rnd.randint(200, 999), rnd.randint(0, 9999)),
                     "word"][kind]
        return " ".join(words), kind
    made = [text() for _ in range(3000)]
    model = pii.fit_rows(task_rows([t for t, _ in made[:1500]]))
    found = pii._selected([t for t, _ in made[1500:]], model)
    added = [(kind, [pii.KINDS[k] for _, k, _ in more]) for (_, kind), (_, more) in zip(made[1500:], found)]
    assert sum(kinds == ["secret"] for kind, kinds in added if kind == 2) > 0.95 * sum(kind == 2 for kind, _ in added)
    assert sum(bool(kinds) for kind, kinds in added if kind != 2) < 0.02 * len(added)


def prose(rnd, n=12):
    return " ".join(rnd.choice(["lorem", "ipsum", "at", "dolor", "amet.", "Sit", "at and.", "of"]) for _ in range(n))


def personal(rnd):
    while True:
        card = "%016d" % rnd.randint(4 * 10 ** 15, 6 * 10 ** 15)
        if luhn(card):
            break
    return [f"{rnd.choice('abcdef')}.{rnd.choice(['smith', 'jones', 'kay'])}{rnd.randint(1, 99)}@{rnd.choice(['mail', 'post'])}.example.org",
            ".".join(str(rnd.randint(1, 255)) for _ in range(4)), card,
            "+1 (%03d) 555-%04d" % (rnd.randint(200, 999), rnd.randint(0, 9999))]


def corpus(n, seed):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        more = [*personal(rnd), "%016d" % rnd.randint(10 ** 15, 10 ** 16 - 1), 'api_key: "%030x"' % rnd.getrandbits(120),
                "%d.%d.%d.%d" % tuple(rnd.randint(256, 999) for _ in range(4)), "supercalifragilisticexpialidocious"]
        out.append(f"{prose(rnd)} {more[i % len(more)]} {prose(rnd)}")
    return out


def test_labels_do_not_follow_from_features():
    """A secret's features hide the name it is assigned to; written-out forms in texts have no label."""
    bare = pii._described("x 0123456789abcdef0123456789 y", [(2, pii.SECRET, 28)])
    text = "x token = 0123456789abcdef0123456789 y"
    assert pii._described(text, [(10, pii.SECRET, 36)]) == bare
    assert [row[:2] for row in pii.labelled(text)] == [(pii.SECRET, 1)]
    for form in ("jane.doe (at) example.org", "jane at example dot org", "jane[at]example.org. The end", "10,20,30,40",
                 "(620) 555-8424"):
        assert not [row for row in pii.labelled(f"lorem {form} ipsum") if row[1] == 0 and row[0] == pii.candidates(form)[0][1]], form
    assert [row[:2] for row in pii.labelled("look at example. The end")] == [(0, 0)]
    card = [row[:2] for row in pii.labelled("pay 4111 1111 1111 1111 now") if row[3] == "4111.1111.1111.1111"]
    assert sorted(card) == [(1, 0), (2, 1)]  # an address by its shape only


def test_every_written_out_form_is_selected_with_its_kind():
    """Forms of spans that the trees never saw, in new texts; plain texts and failing numbers stay."""
    model = pii.fit_rows(task_rows(corpus(1600, 5)))
    rnd, asked, right = random.Random(6), {}, {}
    for _ in range(60):
        for kind, span in enumerate(personal(rnd)):
            for shape, form in enumerate(pii._written_out(kind, span)):
                text = f"lorem ipsum {form} dolor sit"
                (base, added), = pii._selected([text], model)
                asked[kind, shape] = asked.get((kind, shape), 0) + 1
                right[kind, shape] = right.get((kind, shape), 0) + ((12, kind, 12 + len(form)) in added and len(added) == 1)
    assert {k: right[k] / n for k, n in asked.items() if right[k] < 0.95 * n} == {}
    clean = [t for t in corpus(1600, 7) if not pii.base_spans(t) and "api_key" not in t]
    assert sum(bool(added) for _, added in pii._selected(clean, model)) < 0.02 * len(clean)


def test_training_rows_are_the_least_hashes_of_the_whole_table(documents, monkeypatch):
    """Neither order, copies nor the split into tasks changes them; a rare kind is always there."""
    monkeypatch.setattr(pii, "SAMPLE", 20)
    rare = "lorem token = 0123456789abcdef0123456789abcdef ipsum"
    texts = [t for t in corpus(300, 8) if "api_key" not in t] + [rare]
    got = pii.training_rows(documents(texts).repartition(5))
    assert pii.training_rows(documents([*texts[::-1], *texts, None, ""]).repartition(3)) == got
    monkeypatch.setattr(pii, "SAMPLE", 10 ** 6)
    groups = {}
    for row in task_rows(texts):
        groups.setdefault(row[:2], []).append(row)
    assert [tuple(r) for r in got] == [r for g in sorted(groups) for r in groups[g][:20]]
    assert [r.label for r in got if r.kind == pii.SECRET].count(1) == 1
    assert pii.fit(documents([])) is None
