"""Operators that cut or mark texts: decontamination, line dedup, surrogates, pieces."""

from __future__ import annotations

import collections
import itertools
import math
import random
import re
import tracemalloc

import numpy as np
import pytest

from fleetstate.llm import decontaminate, linededup, pieces, pii

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()


def hits_by_hand(text, items):
    find = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    words, hit, ids = find(text), set(), set()
    for item_id, item in items:
        own = find(item)
        size = min(10, len(own))
        windows = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)} if own else set()
        for i in range(len(words) - size + 1) if windows else ():
            if tuple(words[i : i + size]) in windows:
                hit |= set(range(i, i + size))
                ids |= {str(item_id)} if item_id is not None else set()
    return len(words), len(hit), sorted(ids)


@pytest.mark.parametrize("seed", range(3))
def test_decontamination_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    make = lambda n: " ".join(rng.choice(WORDS) + rng.choice(["", ",", "!", "-É"]) for _ in range(n))
    items = [(i, make(rng.choice([0, 1, 3, 9, 10, 11, 40]))) for i in range(15)] + [(None, make(12)), (99, None), (5, make(30))]
    shared = [t for _, t in items if t and len(t.split()) > 9]
    docs = [(i, make(rng.randrange(60)) + " " + rng.choice(shared).upper() + " " + make(5)) for i in range(20)]
    docs += [(i + 100, make(rng.randrange(200))) for i in range(20)] + [(1, None), (2, ""), (2, "!!"), docs[0], (None, docs[0][1])]
    docs += [(500, " ".join([shared[0]] * 300))]
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, row int")
    found = decontaminate.contamination(df, spark.createDataFrame(items, "item_id long, text string")).collect()
    got = sorted((str(r.doc_id), r.n_words, r.n_hit, list(r.item_ids)) for r in found)
    assert got == sorted((str(i), *hits_by_hand(t, items)) for i, t in docs)
    assert all(r.n_hit == sum(s.stop - s.start for s in r.spans) for r in found)
    clean = decontaminate.drop_contaminated(df, spark.createDataFrame(items, "item_id long, text string"))
    assert clean.columns == df.columns
    assert sorted(str(r.doc_id) for r in clean.collect()) == sorted(str(i) for i, t in docs if not hits_by_hand(t, items)[1])


def test_decontamination_of_nothing(spark):
    docs, none = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), "item_id long, text string"
    assert decontaminate.contamination(docs, spark.createDataFrame([], none)).first().n_hit == 0
    assert decontaminate.contamination(docs.limit(0), spark.createDataFrame([(1, "a")], none)).collect() == []


def lines_by_hand(docs, least):
    """What is left of each (id, text), in order of ids: each run of `least` words that stood before is deleted."""
    seen, spots = {}, []
    for key, text in sorted(docs.items()):
        lines = [(i, x.strip(" ")) for i, x in enumerate(text.split("\n")) if x.split()]
        for a in range(len(lines)):
            for b in range(a, len(lines)):
                run = tuple(x for _, x in lines[a : b + 1])
                if sum(len(x.split()) for x in run) >= least:
                    if run in seen:
                        spots.append((key, lines[a][0], lines[b + 1][0] if b + 1 < len(lines) else len(text.split("\n"))))
                    else:
                        seen[run] = key
    out = {}
    for key, text in docs.items():
        gone = {i for k, a, b in spots if k == key for i in range(a, b)}
        out[key] = "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone)
    return out


@pytest.mark.parametrize("seed", range(4))
def test_line_dedup_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    pool = [" ".join(rng.choice(WORDS) for _ in range(rng.choice([0, 1, 2, 3, 5, 12]))) for _ in range(8)]
    texts = ["\n".join(rng.choice(pool) + rng.choice(["", " "]) for _ in range(rng.randrange(14))) for _ in range(12)]
    docs = dict(enumerate(texts + [texts[0], "", "\n\n"]))
    rows = [(i, t, 1, "x") for i, t in docs.items()] + [(0, docs[0], 2, "y"), (77, None, 1, "z")]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string, pos int, `a b` string").repartition(3)
    found = linededup.dedup_lines(df, 10)
    assert found.columns == [*df.columns, "line_report"]
    expected = lines_by_hand(docs, 10)
    for row in found.collect():
        assert row.text == expected.get(row.doc_id)
        removed = 0 if row.text is None else len(docs[row.doc_id].split("\n")) - (len(row.text.split("\n")) if row.text else 0)
        if row.text:
            assert row.line_report.n_removed == removed


def test_line_dedup_cuts_passages_and_leaves_the_rest(spark):
    passage = " ".join(f"w{i}" for i in range(51))
    rows = [(i, f"only {i}\n{passage}\nend {i}") for i in range(40)] + [(100, "only x\nend 1\nshort line"), (101, "end 1\nshort line")]
    found = {r.doc_id: r.text for r in linededup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found[0] == rows[0][1]
    assert all(found[i] == f"only {i}\nend {i}" for i in range(1, 40))
    assert (found[100], found[101]) == (rows[40][1], rows[41][1])
    assert linededup.dedup_lines(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_line_dedup_is_native(spark):
    plan = linededup.op5_line_dedup(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Cartesian|NestedLoop", plan)


def test_permutations_are_without_collisions_or_fixed_points():
    p = pii.Permuter(b"k" * 32)
    for n in (2, 3, 10, 255, 1000):
        image = [p.number(i, n, "t") for i in range(n)]
        assert sorted(image) == list(range(n)) and all(i != j for i, j in enumerate(image))
    names = [a + b for a in "bcdf" for b in "aeio"]
    assert len({p.text(x, "t") for x in names}) == len(names)


def test_surrogates_keep_type_format_and_coreference():
    s = pii.Surrogates(b"k" * 32)
    one, _ = s.replace("Mail Jo.Smith7@mail8.example.com or JO.SMITH7@MAIL8.example.com, call +1 (988) 555-2485 or 988-555-2485.")
    a, b = re.findall(r"\S+@\S+\.com", one)
    assert a.lower() == b.lower() and re.fullmatch(r"[A-Z][a-z]\.[A-Z][a-z]{4}\d@[a-z]{4}\d\.[a-z]{7}\.com", a) and "mith" not in a
    code, short = re.findall(r"\+1 \(\d{3}\) \d{3}-\d{4}|\d{3}-\d{3}-\d{4}", one)
    assert re.sub(r"\D", "", code)[1:] == re.sub(r"\D", "", short) != "9885552485"
    card, _ = s.replace("4111 1111 1111 1111")
    digits = re.sub(r"\D", "", card)
    assert re.fullmatch(r"4\d{3}( \d{4}){3}", card) and pii._luhn(digits[:-1]) == int(digits[-1])
    assert re.fullmatch(r"(10|172|192)\.\d+\.\d+\.\d+", s.replace("10.1.2.3")[0])
    text, found = s.replace("Dr. Anna Schmidt met Hans Meyer. Schmidt and Иван Петров spoke; Meyer left.")
    kinds = {"Anna": ("female", "latin"), "Hans": ("male", "latin"), "Иван": ("male", "cyrillic")}
    for old, group in kinds.items():
        assert old not in text
        assert sum(n in text.split() for n in pii.GIVEN_NAMES[group].split()) >= 1
    assert "Schmidt" not in text and "Meyer" not in text and "Петров" not in text
    surnames = re.findall(r"[A-Z][a-z]+", text)
    assert collections.Counter(surnames).most_common(1)[0][1] == 2
    assert all(text[e["start"] : e["stop"]] for e in found)
    clean = "Version 2.0, section 4.1, in 1999: 12 of 345 (see 7-8)."
    assert s.replace(clean) == (clean, [])


def test_names_are_replaced_before_their_full_form():
    s = pii.Surrogates(b"k" * 32)
    text, found = s.replace("Garcia spoke first. Mr Garcia left; Petrov and Anna Petrov stayed, Garcias too.")
    assert not re.search(r"\bGarcia\b|Petrov", text) and "Garcias" in text
    names = [text[e["start"] : e["stop"]] for e in found]
    assert len(names) == 5 and names[0] == names[1] and names[2] == names[4]
    assert found[0]["entity"] == found[1]["entity"] and found[2]["entity"] == found[4]["entity"]


def test_names_in_any_case_and_script():
    s = pii.Surrogates(b"k" * 32)
    text, found = s.replace("Mr Garcia left. GARCIA spoke, garcia too. Mr. O'Neil, Dr. McDonald and Dr Łuż; Мария Иванова, Mrs Jane Doe.")
    assert not re.search(r"garcia|neil|mcdonald|łuż|мария|иванова|jane|doe", text, re.IGNORECASE)
    names = [text[e["start"] : e["stop"]] for e in found]
    assert names[1] == names[0].upper() and names[2] == names[0].lower() and len({e["entity"] for e in found[:3]}) == 1
    assert re.fullmatch(r"[A-Z]'[A-Z][a-z]{3}", names[3]) and re.fullmatch(r"[A-Z][a-z][A-Z][a-z]{5}", names[4])
    assert names[7].endswith("ова") and names[8].endswith("e")
    # Endings keep to themselves, so that no two names meet.
    words = [a + b + c for a in ("Kov", "Mar", "Lin", "Ann", "Bor") for b in ("", "al", "in") for c in ("", "a", "e", "o", "ska", "ski", "k")]
    assert len({pii._name_word(s.permuter, w) for w in words}) == len(set(words))


def test_passwords_of_signs_are_replaced():
    s = pii.Surrogates(b"k" * 32)
    for secret in ("######", "!@#$%^&*", "密码密码密码", "a#####"):
        text, found = s.replace(f"password={secret}")
        assert len(found) == 1 and secret not in text and text != f"password={secret}"
    signs = ["".join(x) for x in itertools.product("#!?", repeat=4)]
    assert len({pii._secret(s.permuter, x) for x in signs}) == len(signs)


def test_calling_codes_tell_numbers_apart():
    s = pii.Surrogates(b"k" * 32)
    text, found = s.replace("+44 20 1234 5678, +49 20 1234 5678, 0049 20 12345678, +1 (212) 555-0123, 212-555-0123")
    assert [e["type"] for e in found] == ["phone"] * 5
    who = [e["entity"] for e in found]
    assert who[0] != who[1] == who[2] and who[3] == who[4]
    out = [text[e["start"] : e["stop"]] for e in found]
    assert out[0].startswith("+44 ") and out[1].startswith("+49 ") and out[2].startswith("0049 ")
    assert re.sub(r"\D", "", out[0])[2:] != re.sub(r"\D", "", out[1])[2:] == re.sub(r"\D", "", out[2])[4:]


def test_accounts_long_addresses_and_numbers_that_are_none():
    s = pii.Surrogates(b"k" * 32)
    text, found = s.replace("DE89 3704 0044 0532 0130 00 and GB82WEST12345698765432 from 2001:db8::ff00:42:8329, 2001:DB8:0:0:0:ff00:42:8329")
    assert [e["type"] for e in found] == ["account", "account", "address6", "address6"]
    out = [text[e["start"] : e["stop"]] for e in found]
    assert all(pii._is_account(x) for x in out[:2]) and out[0].startswith("DE") and not re.search("3704|WEST|8329", text)
    assert out[2] == out[3] and out[2].startswith("2001:") and found[2]["entity"] == found[3]["entity"]
    clean = "order 1234567890123 at 1700000000000 ms, 12:30:45, aa:bb:cc:dd:ee:ff, std::vector, XX12 3456, a::b"
    assert s.replace(clean)[0] == clean


def test_plain_detector_finds_nothing_that_was_left(spark):
    """A second, plain look: whitespace-separated words of the given documents that hold an address, a card or a long number."""
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()
    s, left = pii.Surrogates(b"k" * 32), []
    for (text,) in rows:
        new, _ = s.replace(text or "")
        known = set(new.split())
        for word in (text or "").split():
            bare = word.strip(".,;:!?()\"'")
            numbers = bare.replace(".", "")
            email = bare.count("@") == 1 and "." in bare.split("@")[1].strip(".")
            address = bare.count(".") == 3 and all(x.isascii() and x.isdigit() and int(x) < 256 and str(int(x)) == x for x in bare.split("."))
            card = numbers == bare and bare.isascii() and bare.isdigit() and 13 <= len(bare) <= 19 and pii._luhn(bare[:-1]) == int(bare[-1])
            if (email or address or card) and word in known:
                left.append(word)
    assert left == []


def test_surrogates_over_a_corpus(spark):
    card = lambda i: f"4{i:014d}{pii._luhn(f'4{i:014d}')}"
    rows = [(i, f"a{i}@b.example.org 10.0.{i}.1 {card(i)} +{44 + i % 2} (30) 555-{1000 + i}", "e") for i in range(60)]
    rows += [(None, None, "e"), (1, "", "e"), (2, "x" * 100_000 + " a1@b.example.org", "e")] + rows[:2]
    df = spark.createDataFrame(rows, "doc_id long, text string, entities string")
    found = pii.with_surrogates(df, "key")
    assert found.columns == ["doc_id", "text", "entities"]
    assert pii.collisions(found).collect() == []
    by_id = collections.defaultdict(set)
    for r in found.collect():
        by_id[r.doc_id].add(r.text)
        for old_id, old, _ in rows:
            if old_id == r.doc_id and old:
                assert not any(w in r.text for w in old.split() if re.search(r"[@.]|\d{9}", w))
    assert len(by_id[0]) == 1 and by_id[None] == {None}
    other = {r.doc_id: r.text for r in pii.with_surrogates(df.filter("doc_id = 5"), "other key").collect()}
    assert other[5] not in by_id[5]
    assert pii.with_surrogates(df.limit(0), "key").collect() == []


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.Vocabulary.load(pieces.MODEL).prepare()


def all_paths(vocabulary, word):
    out = {}

    def go(at, path, weight):
        if at == len(word):
            out[tuple(path)] = math.exp(weight)
        for stop in range(at + 1, len(word) + 1):
            if hit := vocabulary.of.get(word[at:stop]):
                go(stop, [*path, hit[0]], weight + hit[1])

    go(0, [], 0.0)
    total = sum(out.values())
    return {path: share / total for path, share in out.items()}


@pytest.mark.parametrize("word", [b" there", b" Haus", b" ab12"])
def test_pieces_are_drawn_by_their_weights(vocabulary, word):
    n = 20_000
    data, bounds = np.tile(np.frombuffer(word, np.uint8), n), np.arange(n + 1) * len(word)
    seeds = np.arange(n, dtype=np.uint64) * np.uint64(7919)
    ids, cuts = pieces.encode_chunk(vocabulary, data, bounds, seeds)
    found = collections.Counter(tuple(ids[cuts[i] : cuts[i + 1]].tolist()) for i in range(n))
    for path, share in all_paths(vocabulary, word).items():
        assert abs(found[path] / n - share) < 5 * math.sqrt(share * (1 - share) / n) + 1e-3
    for i in range(200):  # the walk for long words draws the same
        assert pieces._walk(vocabulary, word, int(seeds[i]), 0) == ids[cuts[i] : cuts[i + 1]].tolist()


def test_pieces_of_very_many_words_take_little_memory(vocabulary):
    rng = np.random.default_rng(3)
    n = 70_000  # more than a lattice holds
    letters = rng.choice(np.frombuffer(b"etaoinshrdlu", np.uint8), (n, 8))
    letters[:, 0] = ord(" ")
    data, seeds = letters.reshape(-1), np.array([7919], dtype=np.uint64)
    pieces.encode_chunk(vocabulary, data[:800], np.array([0, 800]), seeds)
    tracemalloc.start()
    ids, cuts = pieces.encode_chunk(vocabulary, data, np.array([0, len(data)]), seeds)
    most = tracemalloc.get_traced_memory()[1] / len(data)
    tracemalloc.stop()
    assert most < 200
    back, _ = pieces.decode_ids(vocabulary, ids, cuts)
    assert back.tobytes() == data[1:].tobytes()
    for i in range(0, n, 997):  # the same as word by word, whatever lattice a word is in
        walked = pieces._walk(vocabulary, data[8 * i : 8 * i + 8].tobytes(), 7919, 8 * i)
        ends = np.cumsum(vocabulary.lengths[ids])
        a, b = np.searchsorted(ends, [8 * i, 8 * i + 8], side="right") if i else (0, np.searchsorted(ends, 8, side="right"))
        assert walked == ids[a:b].tolist()


def piece_rows():
    odd = ["hello  world ▁x\n\t é漢字🙂 ", "", None, " ", "   lead", "a" * 1000 + " ñ" * 50, "x" * 299, "▁", "\x00\x7f", "🙂" * 200]
    return [(i, t) for i, t in enumerate(odd)] + [(None, "text"), (3, " "), (0, odd[0])]


def test_pieces_are_lossless_and_reproducible(spark):
    df = spark.createDataFrame([(*r, "x") for r in piece_rows()], "doc_id long, text string, ids string")
    first = pieces.encode(df.repartition(1))
    assert first.columns == ["doc_id", "ids", "n_pieces", "lossless"]
    rows = sorted((str(r.doc_id), str(r.ids), r.n_pieces, r.lossless) for r in first.collect())
    assert all(r[3] for r in rows)
    again = pieces.encode(df.repartition(5)).collect()
    assert rows == sorted((str(r.doc_id), str(r.ids), r.n_pieces, r.lossless) for r in again)
    back = sorted((str(r.doc_id), str(r.text)) for r in pieces.decode(first).collect())
    assert back == sorted((str(i), str(t)) for i, t in piece_rows())
    other = pieces.encode(df, seed=1).collect()
    assert rows != sorted((str(r.doc_id), str(r.ids), r.n_pieces, r.lossless) for r in other)
    assert pieces.encode(df.limit(0)).collect() == []


def test_a_long_word_takes_little_memory_a_byte(vocabulary):
    rng = random.Random(5)
    word = b"\x20" + "".join(rng.choice("abcdeéinorst漢") for _ in range(20_000)).encode()
    tracemalloc.start()
    found = pieces._walk(vocabulary, word, 7, 0)
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert found and peak < 100 * len(word)
