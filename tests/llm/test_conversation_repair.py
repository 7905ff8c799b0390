import hashlib
import itertools
import random
import re
import zlib

import pytest

from epochloom.llm import conversation_repair as cr

COLUMNS = "conv_id long, turn long, role string, text string, cost string, edit string, kind string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "?", "?", "?") for r in rows], COLUMNS).repartition(3)


def outcome(codes, audit):
    """Cost and initials that an audit gives, None where it can't be applied."""
    place, cost, initials = 0, 0, ""
    for edit in audit:
        own = "a" if initials.endswith("u") else "u"
        if edit == "I":
            cost, initials = cost + 2, initials + own
            continue
        if place == len(codes):
            return None
        kind, fault = codes[place] % 4, codes[place] // 4
        place += 1
        if edit == "D":
            cost += 3
        elif fault >= 2:
            return None
        else:
            cost += (2 if edit == "R" else 0) + fault
            initials += own if edit == "R" else "sua?"[kind]
    return (cost, initials) if place == len(codes) else None


def by_trying(codes, longest):
    """The least (cost, audit) of all strings of edits up to a length."""
    found = []
    for n in range(longest + 1):
        for audit in itertools.product("DIKR", repeat=n):
            got = outcome(codes, audit)
            if got and re.fullmatch(r"(s?(ua)+)?", got[1]):
                found.append((got[0], "".join(audit)))
    return min(found)


def by_relaxing(codes):
    """The same by relaxing whole audits until nothing changes."""
    best = {(0, 0): (0, "")}
    for place in range(len(codes) + 1):
        for _ in range(4):
            for state in range(4):
                if (place, state) in best:
                    cost, audit = best[place, state]
                    goal = (place, cr.OWN[state])
                    best[goal] = min(best.get(goal, (9e9, "")), (cost + 2, audit + "I"))
        if place == len(codes):
            break
        kind, fault = codes[place] % 4, codes[place] // 4
        for state in range(4):
            if (place, state) not in best:
                continue
            cost, audit = best[place, state]
            steps = [(state, 3, "D")]
            if fault < 2:
                steps.append((cr.OWN[state], 2 + fault, "R"))
                if cr.STEP[state][kind] >= 0:
                    steps.append((cr.STEP[state][kind], fault, "K"))
            for goal, c, edit in steps:
                at = (place + 1, goal)
                best[at] = min(best.get(at, (9e9, "")), (cost + c, audit + edit))
    return min(best[len(codes), q] for q in (0, 3) if (len(codes), q) in best)


@pytest.mark.parametrize("n", range(4))
def test_edits_against_all_strings_of_edits(n):
    for codes in itertools.product((0, 1, 2, 3, 5, 6, 9), repeat=n):
        assert cr.cheapest_edits(bytes(codes)) == by_trying(codes, n + 2)


@pytest.mark.parametrize("seed", range(4))
def test_edits_against_relaxation(seed):
    rng = random.Random(seed)
    for _ in range(150):
        codes = bytes(rng.choices(range(16), weights=[3, 9, 9, 1] * 2 + [1] * 8, k=rng.randint(0, 30)))
        assert cr.cheapest_edits(codes) == by_relaxing(codes)
    long = bytes(rng.choices((1, 2, 5, 6, 13), k=3000))
    cost, audit = cr.cheapest_edits(long)
    assert (cost, audit) == by_relaxing(long)


def plain_report(rows, ids):
    """The contract of op12, row by row."""
    out = {}
    for conv in ids:
        after = []
        for c, turn, role, text in rows:
            if c != conv:
                continue
            name = f"{' ' if c is None else c}:{' ' if turn is None else turn}"
            kind = zlib.crc32(name.encode()) % 20
            role, text = (" " if x is None else x for x in (role, text))
            if kind == 0:
                continue
            text = {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text)
            role = "user" if kind == 4 else role
            after += [(turn, role, text)] * (2 if kind == 3 else 1)
        digest = lambda r: hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()
        after.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], digest(r)))
        codes, seen = [], set()
        for _, role, text in after:
            solid = re.sub(r"[\x20\x09-\x0D]", "", text)
            fault = 2 if not solid else 3 if (role, text) in seen else int(solid[-1] not in ".!?")
            seen.add((role, text))
            codes.append(("sua".find(role[:1]) if role[:1] in ("s", "u", "a") else 3) + 4 * fault)
        cost, audit = by_relaxing(codes)
        numbers = {t for t, _, _ in after if t is not None}
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        pairs = ["".join(p) for p in itertools.pairwise([r[:1] for _, r, _ in after])]
        lines, at, state = [], iter(after), ""
        for edit in audit:
            own = "assistant" if state.endswith("u") else "user"
            if edit == "I":
                lines.append(f"{own}:")
                state += own[0]
                continue
            _, role, text = next(at)
            if edit != "D":
                role = own if edit == "R" else role
                lines.append(f"{role}:{text}")
                state += role[0]
        faults = [c // 4 for c in codes]
        out[conv] = (
            conv, gaps, faults.count(2), faults.count(3), faults.count(1),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return sorted(map(str, out.values()))


def awkward_turns():
    rng = random.Random(5)
    texts = ["Yes.", "No", "", None, " \t\n", "Why? ", "é!\n", "cut off", "ok.\x85", "x" * 3000 + "."]
    roles = ["user", "assistant", "system", "tool", "", None, "User", "admin"]
    weights = [9, 9, 2, 1, 1, 1, 1, 1]
    rows = []
    for conv in [None, *range(120)]:
        for turn in range(rng.randint(1, 9)):
            number = rng.choices([turn, None, turn * 3], weights=[9, 1, 1])[0]
            text = rng.choice([*texts, f"own words {rng.random()}."])
            rows.append((conv, number, rng.choices(roles, weights)[0], text))
    rows += rows[:40]  # whole rows again
    for turn in range(700):
        rows.append((999, turn, "user" if turn % 2 == 0 else "assistant", f"turn {turn}."))
    for k in range(20, 4000):  # a conversation whose only row is lost
        if zlib.crc32(f"{k * 1000}:0".encode()) % 20 == 0:
            rows.append((k * 1000, 0, "user", "gone."))
            break
    return rows


def test_report_against_the_contract(spark):
    rows = awkward_turns()
    docs = frame(spark, rows)
    found = cr.repair_report(cr.damage(docs), docs.select("conv_id")).collect()
    assert sorted(str(tuple(r)) for r in found) == plain_report(rows, {r[0] for r in rows})


def test_repaired_conversations_are_orderly(spark):
    rows = awkward_turns()
    found = cr.repaired(frame(spark, rows)).collect()
    by_conv = {}
    for r in sorted(found, key=lambda r: r.place):
        by_conv.setdefault(r.conv_id, "")
        by_conv[r.conv_id] += r.role[0]
    assert by_conv and all(re.fullmatch(r"s?(ua)+", x) for x in by_conv.values())
    assert all(r.text == "" and r.turn is None for r in found if r.edit == "I")


def test_empty_table_and_one_repeated_row(spark):
    docs = spark.createDataFrame([], COLUMNS)
    assert cr.repair_report(cr.damage(docs), docs.select("conv_id")).count() == 0
    rows = [(7, 1, "user", "same.")] * 5000
    (row,) = cr.repair_report(frame(spark, rows)).collect()
    assert (row.duplicate, row.cost, row.audit) == (4999, 3 * 4999 + 2, "K" + "D" * 4999 + "I")
