"""Packing, conversation repair and phrases against plain versions."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from annospark.llm import collocations, conversation_repair, packing

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def one_by_one(lengths, capacity):
    """Best fit over falling lengths: the number of sequences."""
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [i for i, r in enumerate(rooms) if r >= n]
        i = min(fits, key=lambda i: rooms[i]) if fits else len(rooms)
        if not fits:
            rooms.append(capacity)
        rooms[i] -= n
    return len(rooms)


@pytest.mark.parametrize("seed", range(30))
def test_steps_equal_best_fit_one_by_one(seed):
    rng = random.Random(seed)
    capacity = rng.choice([5, 16, 64])
    lengths = [rng.randint(1, rng.choice([capacity, max(1, capacity // 3)])) for _ in range(rng.randint(0, 300))]
    counts = Counter(lengths)
    used, seen = defaultdict(list), Counter()
    for length, first, n, each, sequence, base in packing.steps(dict(counts), capacity):
        assert first == seen[length]
        seen[length] += n
        for i in range(n):
            used[sequence + i // each].append((base + i % each * length, length))
    assert seen == counts and len(used) == one_by_one(lengths, capacity)
    for places in used.values():
        end = 0
        for at, length in sorted(places):
            assert at == end
            end += length
        assert end <= capacity


def test_steps_are_bounded_by_the_capacity():
    few = packing.steps({n: 1 + n * 7 % 1000 for n in range(1, 2049)})
    many = packing.steps({n: (1 + n * 7 % 1000) * 10**6 for n in range(1, 2049)})
    assert len(few) < 20_000 and len(many) < 20_000


def test_documents_are_packed_whole(spark):
    rows = [(3, "the cat " * 3000, 1), (1, None, 2), (2, "", 3), (2, "", 3), (None, "no key", 4), (7, "word " * 2047, 5), (8, "x" * 30_000, 6), *((i, "some text " * (i % 90), i) for i in range(20, 400))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `range` long").withColumn("length", F.lit(5)).withColumn("nth", F.lit(1)).repartition(5)
    found = packing.pack_documents(docs, BYTE_BPE, 0).collect()
    library = Tokenizer.from_file(BYTE_BPE)
    want = Counter()
    for doc, text, _ in rows:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        first = len(ids) % 2048 or 2048
        cuts = [0, *range(first, len(ids) + 1, 2048)]
        want.update((doc, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:])))
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == want
    places = defaultdict(list)
    for r in found:
        places[r.sequence_id].append((r.offset, r.length))
    for parts in places.values():
        end = 0
        for at, n in sorted(parts):
            assert at == end
            end += n
        assert end <= 2048
    assert len(places) == one_by_one([r.length for r in found], 2048)
    again = packing.pack_documents(docs.repartition(3), BYTE_BPE, 0).collect()
    assert Counter(found) == Counter(again)
    assert packing.pack_documents(docs.limit(0), BYTE_BPE, 0).collect() == []


MOVES = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}


def every_audit(turns, inserts):
    """Cost and audit of every way to edit, with so many inserts at most."""
    out = []

    def go(i, state, cost, audit, left):
        if i == len(turns) and state in ("", "a"):
            out.append((cost, audit))
        if left:
            for to in ("u", "a"):
                if to in MOVES[state]:
                    go(i, to, cost + 3, audit + "I", left - 1)
        if i < len(turns):
            initial, gone, cut = turns[i]
            go(i + 1, state, cost + 4, audit + "D", left)
            if not gone:
                if initial in MOVES[state]:
                    go(i + 1, MOVES[state][initial], cost + 3 * cut, audit + "K", left)
                for to in ("u", "a"):
                    if to in MOVES[state]:
                        go(i + 1, to, cost + 3 + 3 * cut, audit + "R", left)

    go(0, "", 0, "", inserts)
    return min(out)


def plain_program(turns):
    """The program over whole strings."""

    def put(best, to, x):
        best[to] = min(best.get(to, x), x)

    def filled(best):
        for q in ("", "s", "a"):
            if q in best:
                put(best, "u", (best[q][0] + 3, best[q][1] + "I"))
        if "u" in best:
            put(best, "a", (best["u"][0] + 3, best["u"][1] + "I"))
        return best

    best = filled({"": (0, "")})
    for initial, gone, cut in turns:
        new = {}
        for q, (cost, audit) in best.items():
            put(new, q, (cost + 4, audit + "D"))
            if not gone:
                if initial in MOVES[q]:
                    put(new, MOVES[q][initial], (cost + 3 * cut, audit + "K"))
                for to in ("u", "a"):
                    if to in MOVES[q]:
                        put(new, to, (cost + 3 + 3 * cut, audit + "R"))
        best = filled(new)
    return min(best[q] for q in ("", "a") if q in best)


def program(turns):
    repair, given = conversation_repair.Repair(), ""
    for turn in turns:
        repair.turn(*turn)
        if repair.open >= repair.pause:
            given += repair.edits()
    cost, rest = repair.end()
    return cost, given + rest


def random_turns(rng, n):
    return [(rng.choice("suuaat") if rng.random() < 0.97 else "", rng.random() < 0.15, rng.random() < 0.2) for _ in range(n)]


def test_the_cheapest_of_all_audits_is_found():
    for n in range(4):
        kinds = [("s", False, False), ("u", False, False), ("u", False, True), ("a", False, False), ("x", False, False), ("a", True, False)]
        for turns in itertools.product(kinds, repeat=n):
            assert program(turns) == every_audit(turns, 2 * n + 2)


@pytest.mark.parametrize("pause, mod", [(4096, (1 << 61) - 1), (1, (1 << 61) - 1), (3, 5), (4096, 2)])
def test_long_conversations_and_colliding_hashes(monkeypatch, pause, mod):
    monkeypatch.setattr(conversation_repair, "OPEN_TURNS", pause)
    monkeypatch.setattr(conversation_repair, "_MOD", mod)
    rng = random.Random(pause)
    for _ in range(150):
        turns = random_turns(rng, rng.randint(0, 60))
        assert program(turns) == plain_program(turns)


def test_what_is_held_follows_what_is_open():
    rng, repair = random.Random(5), conversation_repair.Repair()
    for turn in random_turns(rng, 40_000):
        repair.turn(*turn)
        if repair.open >= repair.pause:
            repair.edits()
            assert max(n.depth for _, n in repair.best if n is not None) < 200


def plain_audit(rows):
    """A conversation's row by plain Python; rows are (turn, role, text) after damage, in order."""
    faults, seen, turns = [], set(), []
    for _, role, text in rows:
        if not re.search(r"[^\x20\x09-\x0D]", text):
            faults.append("blank")
        elif (role, text) in seen:
            faults.append("duplicate")
        elif re.findall(r"[^\x20\x09-\x0D]", text)[-1] not in ".!?":
            faults.append("truncated")
        else:
            faults.append("")
        seen.add((role, text))
        turns.append((role[:1], faults[-1] in ("blank", "duplicate"), faults[-1] == "truncated"))
    numbers = [t for t, _, _ in rows if t is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, audit = plain_program(turns)
    left, state, out = list(rows), "", []
    for edit in audit:
        role, text = ("", "") if edit == "I" else left.pop(0)[1:]
        if edit != "D":
            state = "s" if edit == "K" and role[:1] == "s" else ("a" if state == "u" else "u")
            out.append(f"{role if edit == 'K' else {'u': 'user', 'a': 'assistant'}[state]}:{text}")
    return (gaps, *(faults.count(k) for k in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())


def test_conversations_with_odd_rows(spark):
    rng = random.Random(3)
    texts = [None, "", " \t\n", "Yes.", "Yes.", "No", "Why? ", "a" * 50_000 + "!", "naïve…", "ok.\n"]
    roles = ["user", "assistant", "system", None, "", "tool", "User"]
    rows = [(rng.choice([None, *range(40)]), rng.choice([None, *range(12)]), rng.choice(roles), rng.choice(texts)) for _ in range(600)] + [(1000, 1, "user", "Same.")] * 50
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("same", F.lit(1)).withColumn("first", F.lit(2)).repartition(6)
    damaged = conversation_repair.damaged(turns)
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        rest = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(rest, text)
        by[conv] += [(turn, "user" if rest == 4 else role, text)] * {0: 0, 3: 2}.get(rest, 1)
    order = lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode())
    found = {r.conv_id: tuple(r)[1:] for r in conversation_repair.audits(damaged).collect()}
    assert found == {conv: plain_audit(sorted(rs, key=order)) for conv, rs in by.items()}
    whole = defaultdict(list)
    for r in conversation_repair.repaired_turns(damaged).orderBy("position").collect():
        assert r.position == len(whole[r.conv_id])
        whole[r.conv_id].append(f"{r.role}:{r.text}")
    assert {c: hashlib.sha256("\n".join(whole[c]).encode()).hexdigest() for c in by} == {c: row[-1] for c, row in found.items()}
    plain = conversation_repair.audits(turns.where("conv_id = 1000")).collect()
    assert [(r.duplicate, r.cost, r.audit) for r in plain] == [(49, 199, "K" + "D" * 49 + "I")]
    assert conversation_repair.audits(turns.limit(0)).collect() == []


def plain_phrases(rows, least, top):
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = (text or "").translate({c: c + 32 for c in range(65, 91)})
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for size in range(1, 6):
                counts[lang].update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, f in counts.items():
        kept = [p for p, a in f.items() if len(p) > 1 and a >= least]
        covered = {p[i : i + m] for p in kept for m in range(2, len(p)) for i in range(len(p) - m + 1) if f[p[i : i + m]] == f[p]}
        scored = []
        for p in kept:
            if p not in covered:
                score, k = min((1000 * f[p] * totals[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -f[p], " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, i + 1, text.decode(), -a, left, right, totals[lang], -score) for i, (score, a, text, left, right) in enumerate(sorted(scored)[:top])]
    return sorted(out)


def phrase_rows():
    rng = random.Random(11)
    words = ["the", "The", "of", "new", "york", "city", "hall", "naïve", "ß", "x", "日本", "a"]
    rows = [(rng.choice(["en", "de", None, "und"]), "".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ". ", "\n", ","]) for _ in range(rng.randint(0, 60)))) for _ in range(150)]
    return [*rows, ("en", None), ("en", ""), ("de", " \t. \n"), ("en", "new york city hall " * 3000), ("en", "new york.\n" * 2000), *[("fr", "to be or not to be")] * 12]


def test_phrases_equal_a_plain_count(spark):
    rows = phrase_rows()
    docs = spark.createDataFrame(rows, "lang string, text string").withColumn("phrase", F.lit("x")).withColumn("size", F.lit(7)).repartition(4)
    found = sorted(map(tuple, collocations.top_phrases(docs, least=8, top=40).collect()))
    assert found == plain_phrases(rows, 8, 40)
    assert collocations.top_phrases(docs.limit(0)).collect() == []


def test_long_texts_are_parted_where_pieces_end():
    column, langs = pa.array(["one two, three four. " * 50, "plain " * 40, None, "a b"]), pa.array(["en", "de", "de", "en"])
    sizes, total = [], Counter()
    for data, offsets, hashed, rows in collocations.blocks(column, langs, 100):
        runs = collocations.Runs(data, offsets, hashed)
        total.update(rows[runs.row].tolist())
        sizes.append(len(data))
        for a, b in zip(offsets[:-1], offsets[1:]):
            assert bytes(data[a:b]) == b"" or rows[0] != 0 or bytes(data[b - 1 : b]) in (b",", b".", b" ")
    assert total == {0: 200, 1: 40, 3: 2} and max(sizes) <= 350


def test_phrases_with_one_fingerprint_come_apart(monkeypatch):
    monkeypatch.setattr(collocations.Runs, "fingerprints", lambda self, at, size: np.full(len(at), size % 2, np.uint64))
    data = np.frombuffer(b"a b c. a b d, a  b", np.uint8)
    runs = collocations.Runs(data, np.array([0, len(data)]), np.zeros(1, np.uint64))
    found = Counter()
    for _, _, texts, n in collocations.block_phrases(runs, np.full(collocations.LEAST_BITS // 8, 255, np.uint8)):
        found.update(dict(zip(texts, n.tolist())))
    assert found == {"a": 3, "b": 3, "c": 1, "d": 1, "a b": 3, "b c": 1, "b d": 1, "a b c": 1, "a b d": 1}
