"""Licence scans against brute force: notices in units, bodies anywhere, altered texts."""

import random
import re

from plinth.llm import licences
from plinth.llm.licence_texts import BODIES

LEAST = licences.LEAST


def dice(a, b):
    return 2 * len(a & b) / (len(a) + len(b)) if a or b else 0


def of_units(text):
    """{unit: (score, licence)} by comparing every unit with every notice."""
    found = {}
    for unit in {re.sub("[^a-z0-9]+", " ", u.lower()).strip() for u in [*text.split("\n"), *re.split("\n[\x20\x09-\x0d]*\n", text), text]}:
        a = set(licences.bigrams_of(unit))
        scores = [(-dice(a, set(licences.bigrams_of(t))), name) for name, t in licences.TEMPLATES]
        if a and -min(scores)[0] >= LEAST:
            found[unit] = (-min(scores)[0], min(scores)[1])
    return found


def of_windows(text):
    """{(start, size): (score, licence)} by comparing every window with every body."""
    words, found = re.sub("[^a-z0-9]+", " ", text.lower()).strip().split(" "), {}
    if not any(k in text.lower() for k in licences.KEYWORDS):
        return found
    pairs = [f"{x} {y}" for x, y in zip(words, words[1:], strict=False)]
    for name, t in BODIES:
        size, b = licences.word_count(t) - 1, set(licences.bigrams_of(t))
        last = max(0, len(pairs) - size)
        for start in {*range(0, last + 1, max(1, (size + 1) // licences.STEPS)), last}:
            best = (-dice(set(pairs[start : start + size]), b), name)
            if pairs and -best[0] >= LEAST:
                found[start, size] = min(found.get((start, size), best), best)
    return {k: (-s, n) for k, (s, n) in found.items()}


def brute(rows):
    out = {}
    for i, t in rows:
        for score, name in [*of_units(t or "").values(), *of_windows(t or "").values()]:
            n, best = out.get((i, name), (0, 0.0))
            out[i, name] = (n + 1, max(best, score))
    return {(i, name, n, round(best, 9)) for (i, name), (n, best) in out.items()}


def prose(r, n):
    return " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(2, 8))) for _ in range(n))


def altered(r, text, share):
    w = text.split()
    for _ in range(int(len(w) * share)):
        k = r.randrange(len(w))
        r.choice([lambda k=k: w.insert(k, r.choice(["zebra", "the", "quux"])), lambda k=k: w.pop(k), lambda k=k: w.__setitem__(k, "acme")])()
    return " ".join(w)


def made(seed):
    r, rows = random.Random(seed), []
    for _, t in [*licences.TEMPLATES, *BODIES] * 2:
        text = altered(r, t, r.choice([0, 0.03, 0.06, 0.2]))
        lines = re.sub(r"((?:\S+ ){9})", "\\1\n# ", text) if r.random() < 0.5 else text
        rows.append(r.choice([f"{prose(r, r.randint(0, 80))}\n{lines}\n{prose(r, r.randint(0, 80))}", f"{prose(r, 30)} {lines} {prose(r, 40)}", lines]))
    rows += [None, "", " \n", "license", "A license of " + prose(r, 300), " ".join(t for _, t in BODIES), "licensed under the mit license " * 100, BODIES[3][1].upper()]
    return list(enumerate(rows))


def test_scan_is_brute_force(spark):
    rows = made(1)
    docs = spark.createDataFrame([(*row, "clash") for row in rows], "doc_id long, text string, licence string").repartition(4)
    assert {(x.doc_id, x.licence, x.n_units, round(x.best_dice, 9)) for x in licences.find_licences(docs).collect()} == brute(rows)


def test_altered_notices_are_found(spark):
    """Of bodies with 5 % of their words changed, wrapped as comments inside of other text, nine of ten are found, by their own name."""
    r, rows, names = random.Random(7), [], []
    for k in range(4):
        for name, t in BODIES:
            text = re.sub(r"((?:\S+ ){11})", "\\1\n * ", altered(r, t, 0.05))
            rows.append((len(rows), f"/* {prose(r, 20 + k)}\n * {text}\n */\nint main() {{ {prose(r, 200)} }}"))
            names.append(name)
    found = {(x.doc_id, x.licence) for x in licences.find_licences(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert sum((i, n) in found for i, n in enumerate(names)) >= 0.9 * len(names)


def test_each_body_has_a_keyword():
    assert all(any(k in t.lower() for k in licences.KEYWORDS) for _, t in BODIES)


def test_pruning_loses_nothing(spark):
    r, units = random.Random(5), []
    for _, t in licences.TEMPLATES * 6:
        units.append(altered(r, t, r.choice([0, 0.05, 0.15])))
    units += [" ".join(["licensed under the mit license"] * 200), "zebra quux " * 500, " ".join(t for _, t in licences.TEMPLATES)]
    rows = list(enumerate(units))
    found = licences.notices(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = {(i, s, n) for i, t in rows for s, n in {(round(s, 9), n) for s, n in of_units(t).values()}}
    assert {(x.doc_id, round(-x.best.minus, 9), x.best.licence) for x in found} == want and len(want) > 60


def test_empty(spark):
    assert licences.find_licences(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_sql_is_brute_force():
    import duckdb
    import pandas as pd

    rows, con = made(3), duckdb.connect()
    con.register("documents", pd.DataFrame(rows, columns=["doc_id", "text"]))
    assert {(a, b, c, round(d, 9)) for a, b, c, d in con.execute(licences.OP9_SQL).fetchall()} == brute(rows)
