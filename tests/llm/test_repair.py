"""Conversation repair against exhaustive search and a plain dynamic programme."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict
from functools import lru_cache

import pytest

from claimsieve.llm import conversation_repair as cr
from tests.llm.cases import bag

GRAMMAR = re.compile(r"(s?(ua)+)?")
BLANK = re.compile(r"[^\x20\x09-\x0D]")


def faults(rows):
    seen, found = set(), []
    for role, text in rows:
        letters = BLANK.findall(text)
        found.append(
            "b" if not letters else "d" if (role, text) in seen else "t" if letters[-1] not in ".!?" else "k"
        )
        seen.add((role, text))
    return found


def applied(rows, audit):
    """Every outcome of an edit string, whatever roles Rerole and Insert choose: lists of (role, text), or nothing."""
    def go(at, rest):
        if not rest:
            yield from [[]] if at == len(rows) else []
            return
        tails = go(at, rest[1:]) if rest[0] == "I" else go(at + 1, rest[1:]) if at < len(rows) else []
        for tail in tails:
            if rest[0] == "D":
                yield tail
            elif rest[0] == "K":
                yield [rows[at], *tail]
            else:
                for role in ("user", "assistant"):
                    yield [(role, "" if rest[0] == "I" else rows[at][1]), *tail]
    return [out for out in go(0, audit) if GRAMMAR.fullmatch("".join(role[:1] for role, _ in out))]


def cheapest(rows):
    """(cost, audit, repaired rows) by a programme over rows and states, whole audits compared."""
    found = faults(rows)

    @lru_cache(None)
    def best(at, state, inserted):
        options = []
        if at == len(rows) and state in (0, 3):
            options.append((0, "", ()))
        if inserted < 3:
            role = "assistant" if state == 2 else "user"
            cost, audit, rest = best(at, 3 if state == 2 else 2, inserted + 1)
            options.append((cost + 2, "I" + audit, ((role, ""), *rest)))
        if at < len(rows):
            cost, audit, rest = best(at + 1, state, 0)
            options.append((cost + 3, "D" + audit, rest))
            if found[at] not in "bd":
                extra = found[at] == "t"
                role, text = rows[at]
                steps = [("K", role, 0), ("R", "assistant" if state == 2 else "user", 2)]
                for edit, as_role, price in steps:
                    to = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}.get((state, as_role[:1]))
                    if to is not None:
                        cost, audit, rest = best(at + 1, to, 0)
                        options.append((cost + price + extra, edit + audit, ((as_role, text), *rest)))
        return min(options, default=(10**9, "", ()))

    for at in range(len(rows), 0, -1):  # from the end, so that long conversations do not recurse deeply
        for state in range(4):
            best(at, state, 0)
    return best(0, 0, 0)


def plain(talks):
    conversations = defaultdict(list)
    for conv_id, turn, role, text in talks:
        kind = zlib.crc32(f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}".encode()) % 20
        role, text = role if role is not None else " ", text if text is not None else " "
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        row = (turn, "user" if kind == 4 else role, text)
        conversations[conv_id] += [] if kind == 0 else [row] * (2 if kind == 3 else 1)
    result = []
    for conv_id, rows in conversations.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
        turns = {turn for turn, _, _ in rows if turn is not None}
        shown = [(role, text) for _, role, text in rows]
        found = faults(shown)
        initials = [role[:1] for role, _ in shown]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
        cost, audit, fixed = cheapest(shown)
        whole = "\n".join(f"{role}:{text}" for role, text in fixed)
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        result.append(
            (conv_id, gaps, found.count("b"), found.count("d"), found.count("t"), illegal, cost, audit,
             hashlib.sha256(whole.encode()).hexdigest())
        )
    return sorted(result, key=str)


SCHEMA = "conv_id long, turn long, role string, text string, audit string, mark string, digest string"


def table(spark, rows):
    return spark.createDataFrame([(*row, "?", "?", "?") for row in rows], SCHEMA)


def random_talks(seed, conversations, longest):
    rnd = random.Random(seed)
    texts = ["Yes.", "No", "What?", " \n\t", "", "One. ", "…", "日本!", None, "a\x85"]
    roles = ["user"] * 4 + ["assistant"] * 4 + ["system", "tool", "", None, "User"]
    rows = []
    for conv_id in range(conversations):
        for turn in range(rnd.randrange(1, longest)):
            if rnd.random() < 0.9:
                rows.append((conv_id, turn if rnd.random() < 0.95 else None, rnd.choice(roles), rnd.choice(texts)))
    rows += [(None, None, None, None), (None, 1, "user", "x."), (None, 1, "user", "x."), (2**60, -5, "user", "far.")]
    return rows


@pytest.mark.parametrize("seed, conversations, longest", [(1, 400, 6), (2, 60, 40)])
def test_like_plain_version(spark, seed, conversations, longest):
    rows = random_talks(seed, conversations, longest)
    dropped = next(i for i in range(10**6, 10**6 + 1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    rows.append((dropped, 0, "user", "gone."))
    found = cr.repair(table(spark, rows).repartition(4))
    assert found.columns == ["conv_id", *cr.COUNTS, "repaired_sha256"]
    result = bag(found)
    assert result == plain(rows)
    assert (dropped, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) in result


def test_empty_table(spark):
    assert cr.repair(table(spark, [])).count() == 0


def test_hot_conversation_and_extra_columns(spark):
    rows = random_talks(5, 30, 5) + [(7, i, ("user", "assistant")[i % 2], f"line {i % 40}.") for i in range(700)]
    assert bag(cr.repair(table(spark, rows))) == plain(rows)


@pytest.mark.parametrize("length", [0, 1, 2, 3])
def test_least_cost_by_exhaustion(length):
    """All signatures of some rows against every edit string of up to two insertions more than the answer needs."""
    texts = {"k": "fine {}.", "t": "cut {}", "b": " "}
    prices = {"K": 0, "R": 2, "D": 3, "I": 2}
    for kinds in itertools.product("sua", "ktb", repeat=length):
        rows = [
            ({"s": "system", "u": "user", "a": "assistant"}[kinds[2 * i]], texts[kinds[2 * i + 1]].format(i))
            for i in range(length)
        ]
        found = faults(rows)
        answers = []
        for inserts in range(4):
            for edits in itertools.product("KRD", repeat=length):
                if any(e != "D" and f == "b" for e, f in zip(edits, found, strict=True)):
                    continue
                extra = sum(e != "D" and f == "t" for e, f in zip(edits, found, strict=True))
                for places in itertools.combinations(range(length + inserts), inserts):
                    rest = iter(edits)
                    audit = "".join("I" if i in places else next(rest) for i in range(length + inserts))
                    if applied(rows, audit):
                        answers.append((sum(prices[e] for e in audit) + extra, audit))
        signature = "".join(
            "x" if f == "b" else r[0].upper() if f == "t" else r[0] for (r, _), f in zip(rows, found, strict=True)
        )
        path = cr.Path(cr.Automaton())
        path.extend(signature)
        assert path.answer() == min(answers) == cheapest(rows)[:2]


def test_shared_endings_are_worked_out_once():
    rnd = random.Random(3)
    automaton = cr.Automaton()
    kept = cr.Path(automaton)
    signatures = sorted(("".join(rnd.choices("suaoSUAOx", k=rnd.randrange(12))) for _ in range(2000)), key=lambda s: s[::-1])
    for signature in signatures:
        kept.extend(signature)
        fresh = cr.Path(automaton)
        fresh.extend(signature)
        assert kept.answer() == fresh.answer() and kept.arcs == fresh.arcs
    assert len(automaton.relative) < 60
