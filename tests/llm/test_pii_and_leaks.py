"""Personal data and benchmark leaks against brute force."""

import itertools
import math
import random
import re
import time
from collections import Counter

from tabflow.llm import decontaminate, pii

from .conftest import ODD_TEXTS, frame

PATTERNS = {  # fixed values: the base patterns as they are asked for
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _luhn(digits):
    return sum(d if k % 2 == 0 else d * 2 - 9 * (d > 4) for k, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def _passes(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(x) <= 255 for x in value.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and _luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def brute(text):
    return [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text or "", re.A) if _passes(k, m[0])]


def _found(spark, rows):
    got = pii.detect(spark, frame(spark, rows)).collect()
    return Counter((r.doc_id, tuple((x.kind, x.s, x.e) for x in r.base)) for r in got)


def test_base_spans_of_awkward_texts(spark):
    texts = [
        "x@y.z a.b+c@d-e.f.g@h.i j@k k@l..m", "a@b.c_x@d.e", "@a.b @ @@", "é😀 a@b.co 1.2.3.4", "1.2.3.4.5.6.7.8 256.1.1.1 0255.01.1.1 1.2.3",
        "4111 1111 1111 1111 and 4111-1111-1111-1111 4111111111111112", "4111 1111 1111 1111 1", "4111  1111 1111 1111 1111", "5500-0000-0000-0004x",
        "+1 (602) 555-5136, +49 30 1234567-", "+1 2", "++12345678901", "+1234567890123456", "a@b.c  1.1.1.1",
    ]
    rng = random.Random(3)
    texts += ["".join(rng.choice("ab@.-+_ 0123456789()é") for _ in range(80)) for _ in range(300)]
    texts += ["".join(rng.choice("0123456789 -.+") for _ in range(60)) for _ in range(300)]
    rows = list(enumerate(texts)) + [(1000 + i, t) for i, (_, t) in enumerate(ODD_TEXTS)]
    assert _found(spark, rows) == Counter((i, tuple(brute(t))) for i, t in rows)


def test_long_runs_take_no_quadratic_time(spark):
    rows = [(1, "9" * 300_000), (2, "a" * 300_000), (3, "+" + "1-" * 100_000), (4, "1 " * 100_000), (5, "1." * 10_000)]
    ips = tuple(("ip", 8 * k, 8 * k + 7) for k in range(2500))
    assert _found(spark, rows) == Counter({(1, ()): 1, (2, ()): 1, (3, ()): 1, (4, ()): 1, (5, ips): 1})


def test_very_many_matches_of_a_text(spark):
    text = "é 😀 " + " ".join(f"né{k} u{k}@ex.org" for k in range(100_000))
    start = time.monotonic()
    assert _found(spark, [(1, text)]) == Counter({(1, tuple(brute(text))): 1})
    assert pii.redact(spark, frame(spark, [(1, text)])).first().text == re.sub(PATTERNS["email"], "[email]", text)
    assert time.monotonic() - start < 90


def _brute_terms(rows, generalise, remove, support):
    """Places of disclosing terms by doc_id, with contexts, counts and shares recounted from the definition."""
    words = lambda t: re.findall(r"[^\W_]+", t.lower())
    entities, contexts, n_t = {}, {}, Counter()
    for i, t in rows:
        n_t.update(set(words(t)))
        for _, s, e in brute(t):
            entities.setdefault(i, set()).add(t[s:e].lower())
            near = (tuple(words(t[max(s - pii.REACH, 0) : s])[-2:]), tuple(words(t[e : e + pii.REACH])[:2]))
            contexts.setdefault((i, t[s:e].lower()), set()).add(near)
    n, by_entity, joint = len(rows), {}, {}
    for (i, entity), near in contexts.items():
        assert len(near) == 1  # these rows have one place an entity
        by_entity.setdefault(entity, set()).update(near)
        text = dict(rows)[i]
        for _, s, e in sorted(brute(text), reverse=True, key=lambda x: x[1]):
            text = text[:s] + "\n" + text[e:]
        for w in set(words(text)):
            joint.setdefault((entity, w), set()).update(near)
    share = lambda e, w: math.log2(len(joint[e, w]) * n / (max(n_t[w], len(joint[e, w])) * len(by_entity[e]))) / math.log2(n / len(by_entity[e]))
    out = {}
    for i, t in rows:
        best = {}
        for e in entities.get(i, ()):
            for (f, w), near in joint.items():
                if f == e and len(near) >= support and len(by_entity[e]) >= support and share(e, w) >= generalise:
                    best[w] = max(best.get(w, 0), share(e, w))
        places = [(m.start(), m.end(), best[m[0].lower()]) for m in re.finditer(r"[^\W_]+", t) if m[0].lower() in best]
        clear = [(("drop" if x >= remove else "term"), s, e) for s, e, x in places if not any(b < e and s < c for _, b, c in brute(t))]
        out[i] = clear
    return out


def test_terms_against_brute_force(spark):
    rng, rows = random.Random(11), []
    for i in range(400):
        words = [f"w{int(rng.paretovariate(0.7)) % 300}" for _ in range(25)]
        holder = rng.randrange(12)
        if i % 3 == 0:
            words[12:12] = [f"user{holder}@ex.org"]
            words += [f"Name{holder}"] * (rng.random() < 0.9) + [f"Town{holder // 2}"] * (rng.random() < 0.8)
        elif i % 7 == 0:
            words += [f"town{holder // 2}"]
        rows.append((i, " ".join(words)))
    for settings in ((0.8, 0.95, 3), (0.4, 0.7, 2)):
        expected = _brute_terms(rows, *settings)
        assert {k for spans in expected.values() for k, _, _ in spans} == {"term", "drop"}
        got = pii.detect(spark, frame(spark, rows), generalise=settings[0], remove=settings[1], support=settings[2]).collect()
        assert {r.doc_id: [(x.kind, x.s, x.e) for x in r.terms] for r in got} == expected


def test_odd_rows_and_nothing(spark, odd, empty):
    got = Counter((r.doc_id, len(r.base)) for r in pii.detect(spark, odd).collect())
    assert got == Counter((i, len(brute(t))) for i, t in ODD_TEXTS)
    assert pii.detect(spark, empty).collect() == [] and pii.redact(spark, empty).collect() == []


def _corpus():
    rng = random.Random(5)
    filler = [f"w{k}" for k in range(60)]
    say = lambda n: " ".join(rng.choice(filler) for _ in range(n))
    rows = [(i, say(30)) for i in range(200)]
    # "zelda" stands by one address in different contexts and nowhere else; "w1" stands everywhere; copies are no evidence
    rows += [(300 + i, f"{say(12)} Zelda k{i} zelda@ex.org m{i} {say(12)}") for i in range(6)]
    rows += [(400 + i, f"alpha beta quine copy@ex.org gamma delta {'x' * i}") for i in range(6)]
    return rows


def test_terms_that_disclose_an_entity(spark):
    rows = _corpus()
    docs = frame(spark, rows)
    got = {r.doc_id: [dict(rows)[r.doc_id][x.s : x.e] for x in r.terms] for r in pii.detect(spark, docs).collect()}
    assert all(got[300 + i] == ["Zelda"] for i in range(6))
    assert not any(v for k, v in got.items() if not 300 <= k < 306)
    clean = {r.doc_id: r.text for r in pii.redact(spark, docs).collect()}
    assert all("zelda" not in clean[300 + i].lower() and "[email]" in clean[300 + i] for i in range(6))
    assert all(clean[i] == t for i, t in rows if i < 300)
    milder = {r.doc_id: r.text for r in pii.redact(spark, docs, remove=2.0).collect()}
    assert "[term]" in milder[300]


def test_disclosing_terms_far_from_the_entity(spark):
    rng = random.Random(6)
    say = lambda n: " ".join(f"w{rng.randrange(60)}" for _ in range(n))
    rows = [(i, say(30)) for i in range(200)]
    rows += [(300 + i, f"Zelda É😀 {say(80)} k{i} z@ex.org m{i} {say(80)} (zelda).") for i in range(6)]
    # one document alone is no evidence, however often it names the address
    rows += [(400, " ".join(f"Quine a{k} b{k} q@ex.org c{k} d{k}" for k in range(6)))]
    got = {r.doc_id: [dict(rows)[r.doc_id][x.s : x.e] for x in r.terms] for r in pii.detect(spark, frame(spark, rows)).collect()}
    assert all(got[300 + i] == ["Zelda", "É", "zelda"] for i in range(6))
    assert not any(v for k, v in got.items() if not 300 <= k < 306)


def test_redaction_keeps_columns_and_handles_overlaps(spark):
    rows = [(1, "call +1 602 555 5136 or 4111 1111 1111 1111 from 10.0.0.1, a@b.co", "s", 1), (2, None, None, None), (3, "clean", "t", 5)]
    got = pii.redact(spark, frame(spark, rows, "doc_id long, text string, source string, n_chars long")).orderBy("doc_id").collect()
    # the phone pattern runs on from +1 as far as blanks and digits go
    assert got[0].text.startswith("call [phone] or [card] from [ip], [email]") and got[0].n_chars == len(got[0].text)
    assert tuple(got[1]) == rows[1] and tuple(got[2]) == rows[2]


def test_each_mask_hits_windows_with_substitutions():
    for mask in decontaminate.MASKS:
        for bad in itertools.combinations(range(decontaminate.WINDOW), decontaminate.SUBSTITUTIONS):
            assert any(all(p + k not in bad for k, b in enumerate(mask) if b == "1") for p in range(decontaminate.WINDOW - len(mask) + 1))


def _tokens(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def _leaks(docs, items):
    out = set()
    for i, t in docs:
        d = _tokens(t)
        for j, b in items:
            b = _tokens(b)
            n = min(13, len(b))
            allowed = 2 if n == 13 else 1 if n >= 8 else 0
            if 0 < n < 4:
                hit = d == b
            else:
                hit = n and any(sum(x == y for x, y in zip(d[p : p + n], b[q : q + n])) >= n - allowed for p in range(len(d) - n + 1) for q in range(len(b) - n + 1))
            if hit:
                out.add((i, j))
    return out


def test_leaks_against_brute_force(spark, monkeypatch):
    rng = random.Random(7)
    words = [f"v{k}" for k in range(50)]
    items = [(j, " ".join(rng.choices(words, k=n))) for j, n in enumerate([0, 3, 7, 8, 9, 13, 20, 40, 40, 1, 2, 4, 5, 6, 10, 11, 12])] + [(50, None), (None, " ".join(rng.choices(words, k=20)))]
    docs = []
    for i in range(120):
        d = rng.choices(words, k=rng.choice([0, 5, 30, 100]))
        if rng.random() < 0.7:
            b = _tokens(rng.choice(items)[1])[rng.choice([0, 0, 5]) :]
            for _ in range(rng.choice([0, 1, 2, 3, 4])):
                if b:
                    b[rng.randrange(len(b))] = rng.choice(words)
            at = rng.randrange(len(d) + 1)
            d[at:at] = b
        docs.append((i, ", ".join(d).title()))
    docs += [(1000, None), (None, items[7][1]), *((2000 + j, t) for j, t in items[:-2])]
    expected = _leaks(docs, items)
    assert len(expected) > 40 and {n for n in range(1, 17)} - {j for _, j in expected} == set()
    got = decontaminate.overlaps(spark, frame(spark, docs), frame(spark, items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in got} == expected and len(got) == len(expected)
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 40)  # several blocks of items
    again = decontaminate.overlaps(spark, frame(spark, docs), frame(spark, items, "item_id long, text string")).collect()
    assert set(again) == set(got)
    kept = decontaminate.decontaminate(spark, frame(spark, docs), frame(spark, items, "item_id long, text string"))
    assert Counter(map(tuple, kept.collect())) == Counter(r for r in docs if not any(i == r[0] for i, _ in expected))


def test_leaks_of_odd_texts_and_nothing(spark, odd, empty):
    items = frame(spark, [(1, "the quick brown fox jumps over the lazy dog"), (1, "the quick brown fox jumps over the lazy dog")], "item_id long, text string")
    got = decontaminate.overlaps(spark, odd, items).collect()
    assert sorted((r.doc_id, r.item_id, r.word_from, r.n_words, r.n_equal) for r in got) == [(6, 1, 0, 9, 9), (7, 1, 0, 9, 9)]
    assert decontaminate.overlaps(spark, empty, items).collect() == []
    assert decontaminate.overlaps(spark, odd, items.limit(0)).collect() == []


def test_native_plans_run_no_python(spark, odd):
    items = frame(spark, [(1, "the quick brown fox jumps over the lazy dog")], "item_id long, text string")
    for df in (pii.detect(spark, odd), pii.redact(spark, odd.select("doc_id", "text")), decontaminate.overlaps(spark, odd, items)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)
