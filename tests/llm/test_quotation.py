from __future__ import annotations

import random
import re

import pytest

from loomstat.llm import quotation

MARKS = re.compile(r"^(?:[ \t]*>)+")
SCHEMA = "conv_id bigint, turn int, role string, text string, path string"


def brute(rows):
    """(conv, turn) -> (quoted lines, linked lines, replied turn) and each conversation's turns in reply order."""
    def level(line):
        found = MARKS.match(line)
        return found[0].count(">") if found else 0

    def norm(line):
        return re.sub(r"\s+", " ", MARKS.sub("", line).lower()).strip(" ")

    messages = {}
    for conv, turn, text in rows:
        if conv is not None and turn is not None:
            messages.setdefault(conv, {}).setdefault(turn, []).extend((text or "").split("\n"))
    links, order = {}, {}
    for conv, turns in messages.items():
        own = {t: {norm(x) for x in lines if not level(x) and norm(x)} for t, lines in turns.items()}
        children = {}
        for t in sorted(turns):
            counts, quoted = {}, 0
            for line in turns[t]:
                if level(line) and norm(line):
                    quoted += 1
                    origin = max((u for u in turns if u < t and norm(line) in own[u]), default=None)
                    if origin is not None:
                        key = (-level(line), origin)
                        counts[key] = counts.get(key, 0) + 1
            best = max(((lv, n, o) for (lv, o), n in counts.items()), default=None)
            reply = best[2] if best else max((u for u in turns if u < t), default=None)
            links[conv, t] = (quoted, sum(counts.values()), reply)
            children.setdefault(reply, []).append(t)
        walk, stack = [], sorted(children.get(None, []), reverse=True)
        while stack:
            t = stack.pop()
            walk.append(t)
            stack += sorted(children.get(t, []), reverse=True)
        order[conv] = walk
    return links, order


def cases():
    rnd = random.Random(9)
    said = ["I think so", "No  way", "é voilà", "what about it?", ">", ""]
    rows = []
    for conv in range(12):
        lines = [f"{rnd.choice(said)} {i % 7}" for i in range(40)]
        for turn in range(rnd.randint(1, 25)):
            text = [rnd.choice(lines) for _ in range(rnd.randint(0, 3))]
            for _ in range(rnd.choice([0, 0, 1, 3])):
                text.insert(0, rnd.choice(["> ", ">", "> > ", ">>> ", " >"]) + rnd.choice(lines).upper())
            rows.append((conv, turn * rnd.choice([1, 1, 1, 3]), "\n".join(text)))
    rows += [(50, t, f"own line {t}" if t % 40 else f"> own line {t // 2}\nnew {t}") for t in range(3000)]
    rows += [(None, 1, "> x"), (60, None, "y"), (61, 0, None), (61, 1, ""), (61, 1, "> nowhere"), (61, 2, "x" * 100_000), rows[0]]
    return rows


def test_against_definition(spark):
    rows = cases()
    frame = spark.createDataFrame([(c, t, "user", x, "clash") for c, t, x in rows], SCHEMA).repartition(4)
    linked = quotation.link_conversations(frame)
    plan = linked._jdf.queryExecution().toString()
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
    found = linked.collect()
    assert len(found) == len(rows)
    links, order = brute(rows)
    placed = {}
    for r in found:
        text = r.row.text or ""
        assert r.own == "\n".join(x for x in text.split("\n") if not MARKS.match(x))
        assert r.row.path == "clash"
        if r.row.conv_id is None or r.row.turn is None:
            assert r.reply_to is None and r.path is None
            continue
        assert (r.n_quoted, r.n_linked, r.reply_to) == links[r.row.conv_id, r.row.turn], r
        placed.setdefault(r.row.conv_id, set()).add((r.path, r.row.turn))
    for conv, turns in order.items():
        assert [t for _, t in sorted(placed[conv])] == turns, conv


@pytest.mark.parametrize("stretch", [2, 7])
def test_stretches_make_no_difference(spark, monkeypatch, stretch):
    rows = [(g, o, None if o % 3 else o) for g in (1, 2) for o in range(40)] + [(1, 5, 500), (3, 0, 1)]
    frame = spark.createDataFrame(rows, "g int, o bigint, v bigint")
    monkeypatch.setattr(quotation, "STRETCH", stretch)
    for r in quotation.latest_before(frame, ["g"], "o", "v", "found").collect():
        before = [(o, v) for g, o, v in rows if g == r.g and o < r.o and v is not None]
        latest = max((o for o, _ in before), default=None)
        assert r.found in ({None} if latest is None else {v for o, v in before if o == latest})


def test_empty_table(spark):
    assert quotation.link_conversations(spark.createDataFrame([], SCHEMA)).collect() == []
