"""Decontamination against a plain matcher over token strings, and its recall on re-parameterised items."""

import random
import re

import pytest

from quillgraph.llm import decontam

SLOTS = {"number": "<num>", "unit": "<unit>", "name": "<name>"}


def template(text, names, heads=False):
    """(value, raw, kind) of each token, by the definition."""
    text = text if names else text.casefold()
    out, end = [], None
    for m in re.finditer(r"\d+(?:[.,]\d+)*|[A-Za-z]+", text):
        word = m[0].lower()
        opens = end is None or re.search(r"[.!?:;\n\r]", text[end : m.start()])
        kind = "number" if word[0].isdigit() else "word"
        if names and kind == "word" and m[0][0].isupper() and (heads or not opens):
            kind = "name"
        if out and out[-1][2] == "number" and kind != "number" and word in decontam.UNITS:
            kind = "unit"
        end = m.end()
        if kind == "name" and out and out[-1][2] == "name":
            out[-1] = (out[-1][0], out[-1][1] + " " + word, "name")
        else:
            out.append((SLOTS.get(kind, word), word, kind))
    return out


def windows(tokens, size):
    """(position, values, slots) of the windows with three plain words."""
    for at in range(len(tokens) - size + 1):
        part = tokens[at : at + size]
        if sum(k == "word" for *_, k in part) >= decontam.PLAIN:
            yield at, tuple(v for v, *_ in part), [r for _, r, k in part if k != "word"]


def plain_leaks(docs, items):
    found = set()
    for item_id, text in items:
        kinds = {names: template(text, names) for names in (True, False)}
        wanted = {names: [w for n in (3, 4, 5) if n == 5 or len(t) == n for w in windows(t, n)] for names, t in kinds.items()}
        for doc_id, body in docs:
            for names, mine in wanted.items():
                tokens = template(body, names)
                lines = {}
                for at, values, slots in mine:
                    for pos, other, found_slots in windows(tokens, len(values)):
                        if other == values:
                            places, pairs = lines.setdefault(pos - at, (set(), set()))
                            places.add(at)
                            pairs.update(zip(slots, found_slots))
                covered = set()
                for places, pairs in lines.values():
                    values = len({a for a, _ in pairs})
                    if len(pairs) - values <= decontam.INCONSISTENT * values:
                        covered |= places
                if mine and len(covered) >= decontam.CONTAINMENT * len(mine):
                    found.add((doc_id, item_id))
            runs = [template(text, True)] if not any(wanted.values()) else []
            if not any(wanted.values()) or len(kinds[False]) <= decontam.SHORT:
                runs.append(template(text, True, heads=True))
            for own in runs:
                words = sum(k == "word" for *_, k in own)
                if len(own) < decontam.DENSE_TOKENS or not decontam.DENSE_PLAIN <= words < len(own):
                    continue
                if any(k == "name" for *_, k in own) or own == runs[0]:
                    for tokens in (template(body, True), template(body, True, heads=True), template(body, False)):
                        for at in range(len(tokens) - len(own) + 1):
                            part = tokens[at : at + len(own)]
                            if [v for v, *_ in part] == [v for v, *_ in own]:
                                pairs = {(a, b) for (_, a, k), (_, b, _) in zip(own, part) if k != "word"}
                                values = len({a for a, _ in pairs})
                                if len(pairs) - values <= decontam.INCONSISTENT * values:
                                    found.add((doc_id, item_id))
            numbers = [r for _, r, k in kinds[False] if k == "number"]
            if numbers and len(numbers) == len(kinds[False]) and [(r, k) for _, r, k in template(body, False)] == [(r, "number") for r in numbers]:
                found.add((doc_id, item_id))
            if not any(wanted.values()) and any(k != "number" for *_, k in kinds[False]):
                raw, own = [r for _, r, _ in template(body, False)], [r for _, r, _ in kinds[False]]
                if any(raw[i : i + len(own)] == own for i in range(len(raw) - len(own) + 1)):
                    found.add((doc_id, item_id))
    return found


def questions(rng, n):
    """Items with names, numbers and units, and a way to fill them again."""
    verbs, things = "buys sells finds loses counts paints washes carries".split(), "apples stones books lamps ropes coins boxes shirts wheels".split()
    names = "Anna Tom Maria Peter Lucy George Nina Oscar".split()
    shapes = []
    for _ in range(n):
        a, b, c = rng.choice(verbs), rng.choice(things), rng.choice(things)
        tail = " ".join(rng.choice(things) + " " + rng.choice(verbs) for _ in range(3))
        shapes.append(f"Early on {{0}} {a} {{2}} kg of {b} while {{1}} {rng.choice(verbs)} {{3}} {c} near the old {rng.choice(things)}. How many {b} does {{0}} keep after {{2}} days of {tail}?")

    def fill(shape):
        first, second = rng.sample(names, 2)
        return shape.format(first, second, rng.randint(2, 99), rng.randint(100, 999))

    return shapes, fill


def run(spark, docs, items):
    found = decontam.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    return {(r.doc_id, r.item_id) for r in found.collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_like_the_plain_matcher(spark, seed):
    rng = random.Random(seed)
    shapes, fill = questions(rng, 12)
    items = [(i, fill(s)) for i, s in enumerate(shapes)] + [(100, "Add 3 4 5"), (101, "What is 12 + 15?"), (102, "7 8 9"), (103, "old lamps near"), (104, ""), (105, "Tom has 5 apples"), (106, "Is 4 kg of 9 lamps old?")]
    docs = [(900, "7, 8; 9"), (901, "7 8 9 10"), (902, "So Lucy has 9 apples now"), (903, "Then. Nina has 9 apples. And Is 7 lb of 7 lamps old"), (904, "he has 5 apples")]
    for k in range(60):
        text = fill(rng.choice(shapes)) if k % 2 else rng.choice(items)[1]
        words = text.split() or ["nothing"]
        for _ in range(rng.randint(0, 6)):  # edits of every degree
            words[rng.randrange(len(words))] = rng.choice(["apples", "Zed", "77", "kg", "old", "."])
        docs.append((k, " ".join(["So it goes."] * rng.randint(0, 1) + words + fill(rng.choice(shapes)).split()[: rng.randint(0, 9)])))
    expected = plain_leaks(docs, items)
    assert 10 < len(expected) and run(spark, docs, items) == expected


def test_recall_on_reparameterised_items(spark):
    rng = random.Random(7)
    shapes, fill = questions(rng, 80)
    items = [(i, fill(s)) for i, s in enumerate(shapes)]
    docs = [(i, "Some words before it. " + fill(s) + " And some behind.") for i, s in enumerate(shapes)]
    clean = []  # the same words, names and numbers in another order
    for i, s in enumerate(shapes):
        words = fill(s).split()
        rng.shuffle(words)
        clean.append((1000 + i, " ".join(words)))
    found = run(spark, docs + clean, items)
    recall = len({(i, i) for i in range(80)} & found) / 80
    assert recall >= 0.9
    assert not {d for d, _ in found if d >= 1000}


def test_names_in_other_scripts(spark):
    item = "Вчера Иван купил 12 яблок у Анны, сколько яблок осталось у Ивана после обеда?"
    docs = [(1, "Так. Вчера Олег купил 30 яблок у Нины, сколько яблок осталось у Олега после обеда?"), (2, "Вчера шёл дождь и никто ничего не купил.")]
    assert {d for d, _ in run(spark, docs, [(1, item)])} == {1}


def test_short_and_dense_items(spark):
    items = [(1, "What is 12 + 15 * 3?"), (2, "12 15 99"), (3, "Alice has 5 apples"), (4, "Compute 7 * 7")]
    docs = [
        (1, "So. What is 13 + 16 * 4? Nobody knows."), (2, "12 15 99"), (3, "We hear that Bob has 7 apples in a box."), (4, "Carol has 9 apples."), (5, "what is 12 + 15 * 3"),
        (6, "what is 13 or 16 and 4"), (7, "a table 11 12 15 99 100"), (8, "somebody has 7 apples"), (9, "12 15"), (10, "we compute 7 * 7 here"), (11, "we compute 8 * 8 here"), (12, None),
    ]
    assert run(spark, docs, items) == {(1, 1), (5, 1), (2, 2), (3, 3), (4, 3), (10, 4)}


def test_recall_on_short_items_and_clean_texts(spark):
    """Items of 4 to 8 tokens filled again, in the middle and at the head of a sentence; what the rules leave out is counted."""
    rng = random.Random(11)
    names = "Anna Tom Maria Peter Lucy George Nina Oscar".split()
    shapes = ["{0} has {2} apples", "What is {2} + {3} * {4}?", "{0} gave {1} {2} coins", "How many are {2} and {3} lamps?", "{0} walks {2} km in {3} hours", "Add {2} to {3}", "{2} + {3}", "{0} sees {1}"]
    fill = lambda s: s.format(*rng.sample(names, 2), *(rng.randint(2, 99) for _ in range(3)))
    items = [(i, fill(s)) for i, s in enumerate(shapes)]
    docs = [(10 * i + k, lead + fill(s) + " and so on it went.") for i, s in enumerate(shapes) for k, lead in enumerate(["", "We know that ", "Well. "])]
    words = "the old lamp stood near a river while people talked about many things and nobody counted apples or coins in hours".split()
    clean = [(1000 + k, " ".join(rng.choice([*words, "Tom", "Lucy", "12", "7"]) for _ in range(300)).capitalize()) for k in range(100)]
    found = run(spark, docs + clean, items)
    hits = {i: sum((10 * i + k, i) in found for k in range(3)) for i in range(len(shapes))}
    assert not {d for d, _ in found if d >= 1000}
    # Left out: runs of fewer than four tokens or of fewer than two plain words.
    assert [hits[i] for i in range(len(shapes))] == [3, 3, 3, 3, 3, 3, 0, 0]
