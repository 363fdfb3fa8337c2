"""Preference formatting against a plain Python version."""

import os
import sys

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "..", "tools"))

from cohortlens.llm import preferences  # noqa: E402
from cohortlens.llm.queries import QUERIES  # noqa: E402

SCHEMA = "pair_id long, chosen boolean, turn long, role string, text string, c string, r string, n_common string"


def brute(rows):
    sides = {}
    for p, chosen, turn, role, text, *_ in rows:
        if p is not None and chosen is not None:
            sides.setdefault(p, ([], []))[not chosen].append(
                ((turn is not None, turn or 0), "unknown" if role is None else role, text or ""))
    out = []
    for p, (c, r) in sides.items():
        if not c or not r:
            continue
        c, r = [x[1:] for x in sorted(c)], [x[1:] for x in sorted(r)]
        n = 0
        while n < min(len(c), len(r)) and c[n] == r[n]:
            n += 1

        def render(turns):
            text, spans = "", []
            for role, t in turns:
                text += f"<|{role}|>\n"
                start = len(text)
                text += t + "<|end|>\n"
                if role == "assistant":
                    spans.append((start, len(text)))
            return text, spans

        (a, sa), (b, sb) = render(c[n:]), render(r[n:])
        out.append((p, n, render(c[:n])[0], a, b, sa, sb))
    return out


def test_pairs_equal_brute_force(spark):
    rows = [
        (1, True, 0, "user", "hi"), (1, True, 1, "assistant", "good ü"), (1, False, 0, "user", "hi"), (1, False, 1, "assistant", "bad"),
        (1, False, 2, "user", "more"), (1, False, 3, "assistant", "x" * 100_000),
        (2, True, 0, "user", "same"), (2, False, 0, "user", "same"),                       # equal: empty completions
        (3, True, 0, "system", None), (3, True, 1, None, "a"), (3, False, 0, "user", ""),   # nothing in common
        (4, True, 0, "user", "alone"),                                                      # one side: no pair
        (5, True, None, "user", "n"), (5, True, 0, "assistant", "b"), (5, True, 0, "assistant", "a"), (5, True, 0, "assistant", "a"),
        (5, False, None, "user", "n"), (5, False, 0, "assistant", "a"), (5, False, 0, "assistant", "b"),
        (None, True, 0, "user", "no pair"), (6, None, 0, "user", "no side")]
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)
    got = [(r.pair_id, r.n_common, r.prompt, r.chosen, r.rejected, [tuple(s) for s in r.chosen_spans], [tuple(s) for s in r.rejected_spans])
           for r in preferences.format_pairs(df).collect()]
    assert sorted(got) == sorted(brute(rows)) and len(got) == 4
    for _, _, _, chosen, _, spans, _ in got:  # a span is what the assistant says, with its end mark
        assert all(chosen[a:b].endswith("<|end|>\n") for a, b in spans)
    assert preferences.format_pairs(df.limit(0)).count() == 0


def test_last_turn_pairs_share_all_before(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "a1"), (1, 2, "user", "more"), (1, 3, "assistant", "a2"), (1, 4, "user", "thanks"),
            (7, 0, "user", "x"), (9, None, None, None), (9, 1, "assistant", "b"), (5000, 0, "assistant", "alone"), (None, 0, "user", "n")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.pair_id: (r.n_common, r.chosen, r.rejected, [tuple(s) for s in r.rejected_spans]) for r in preferences.last_turn_pairs(df).collect()}
    say = lambda t: f"<|assistant|>\n{t}<|end|>\n"
    thanks = "<|user|>\nthanks<|end|>\n"
    assert got == {1: (3, say("a2") + thanks, say("b") + thanks, [(14, 23)]), 7: (1, "", "", []),
                   9: (1, say("b"), say("a2"), [(14, 24)]), 5000: (0, say("alone"), say(""), [(14, 22)])}
    assert preferences.last_turn_pairs(df.limit(0)).count() == 0


def test_query_pairs_share_turns(spark, sf_dir):
    got = QUERIES["op3_preferences"](spark, sf_dir).collect()
    assert any(r.n_common and r.chosen != r.rejected for r in got)
    assert len(got) == spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id").distinct().count()
