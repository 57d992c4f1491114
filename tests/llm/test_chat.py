import random

from vitalmart.llm import chat


def plain(turns, pairs):
    talk = {}
    for c, t, r, x in {(c, t, r or "", x or "") for c, t, r, x, *_ in turns if c is not None and t is not None}:
        talk.setdefault(c, []).append((t, r, x))
    talk = {c: [y[1:] for y in sorted(v)] for c, v in talk.items()}
    out = []
    for p, a, b in pairs:
        a, b = talk.get(a, []), talk.get(b, [])
        n = 0
        while n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1

        def side(rest):
            text, spans = "", []
            for r, x in rest:
                text += f"<|{r}|>\n"
                begin = len(text)
                text += f"{x}<|end|>\n"
                if r == "assistant":
                    spans.append((begin, len(text)))
            return text, spans

        out.append((p, n, side(a[:n])[0], side(a[n:])[0], side(b[n:])[0], side(a[n:])[1], side(b[n:])[1]))
    return out


def test_against_loops(spark):
    rng = random.Random(3)
    turns = []
    for c in range(60):
        for t in range(rng.randrange(1, 6)):
            turns.append((c, t, ["user", "assistant"][t % 2], rng.choice(["é", "hi🙂", "ok then"]), 1))
    turns += [(5, 0, turns[0][2], None, 1), (61, None, "user", "lost", 1), (None, 0, "user", "lost", 1), (62, 0, None, "no role", 1)]
    turns += [t for t in turns if t[0] == 7] + [(63, 10 - i, "assistant", str(i), 1) for i in range(5)] + [(64, i, "user", "x" * 50, 1) for i in range(3000)]
    pairs = [(i, 2 * i, 2 * i + 1) for i in range(33)] + [(40, 3, 3), (41, 4, None), (42, None, None), (43, 999, 2), (43, 999, 2), (44, 63, 62)]
    t = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string, chosen int")
    p = spark.createDataFrame(pairs, "pair_id bigint, chosen_id bigint, rejected_id bigint")
    got = [(r.pair_id, r.n_prompt_turns, r.prompt, r.chosen, r.rejected, [tuple(s) for s in r.chosen_mask], [tuple(s) for s in r.rejected_mask])
           for r in chat.preference_examples(t, p).collect()]
    assert sorted(got) == sorted(plain(turns, pairs))
    assert any(n for _, n, *_ in got)
    assert chat.preference_examples(t, p.limit(0)).count() == 0
    assert {r.prompt + r.chosen + r.rejected for r in chat.preference_examples(t.limit(0), p).collect()} == {""}


def test_no_python_in_the_plan(spark, capsys):
    t = spark.createDataFrame([(1, 0, "user", "x")], "conv_id bigint, turn bigint, role string, text string")
    chat.preference_examples(t, spark.createDataFrame([(1, 1, 2)], "pair_id bigint, chosen_id bigint, rejected_id bigint")).explain()
    assert "Python" not in capsys.readouterr().out
