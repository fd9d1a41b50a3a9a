"""Quotes are linked and taken out; threads follow replies."""

import random

from tracklab.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"


def by_turn(df):
    return {(r.conv_id, r.turn): r for r in df.collect()}


def test_levels_links_and_paths(frame):
    rows = [
        (1, 0, "a", "Hello there my friends\nHow is it going today?"), (1, 1, "b", "Fine thanks, and what about you?"),
        (1, 2, "c", "On Monday a wrote:\n> Hello there my friends\n> How is it going today?\n\nBad, really."),
        (1, 3, "a", "> > How is it going today?\n> Bad, really.\nSorry to hear."),
        (1, 4, "b", "> fine  THANKS, and what\n> about you?\nMe too\n> nowhere said thing at all"),
        (1, 5, "b", "  >Sorry to hear.\nok > fine"), (2, 0, "a", "How is it going today?"), (2, 1, "b", "> Me too\nnot of this conversation"),
    ]
    got = by_turn(chat.linked(frame(rows, SCHEMA)))
    assert {k: r.reply_to for k, r in got.items()} == {(1, 0): None, (1, 1): None, (1, 2): 0, (1, 3): 2, (1, 4): 1, (1, 5): 3, (2, 0): None, (2, 1): None}
    assert got[1, 5].path == [0, 2, 3, 5] and got[1, 4].path == [1, 4] and got[2, 1].path == [1]
    assert (got[1, 2].text, got[1, 3].text, got[1, 4].text, got[1, 5].text) == ("Bad, really.", "Sorry to hear.", "Me too", "ok > fine")
    assert [(got[1, t].n_quotes, got[1, t].n_linked, got[1, t].max_level) for t in (2, 3, 4)] == [(1, 1, 1), (2, 2, 2), (2, 1, 1)]
    assert [(r.conv_id, r.turn) for r in chat.conversations(frame(rows, SCHEMA)).collect()] == [
        (1, 0), (1, 2), (1, 3), (1, 5), (1, 1), (1, 4), (2, 0), (2, 1)]


def test_random_threads_come_back(frame):
    rng = random.Random(6)
    rows, parent = [], {}
    for conv in range(6):
        for turn in range(40):
            body = f"Message {conv} {turn} says " + " ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(5))
            above = rng.randrange(turn) if turn and rng.random() < 0.8 else None
            parent[conv, turn] = above
            quote = ""
            if above is not None:
                said = next(t for c, n, _, t in rows if (c, n) == (conv, above))
                quote = "".join(f"> {x}\n" for x in said.split("\n"))  # nested quotes come along
            rows.append((conv, turn, "r", quote + body))
    rng.shuffle(rows)
    got = by_turn(chat.linked(frame(rows, SCHEMA, 3)))
    for (conv, turn), above in parent.items():
        path = [turn]
        while parent[conv, path[0]] is not None:
            path.insert(0, parent[conv, path[0]])
        assert (got[conv, turn].reply_to, got[conv, turn].path) == (above, path)
        assert got[conv, turn].max_level == len(path) - 1 and ">" not in got[conv, turn].text


def test_nulls_repeats_ties_and_clashes(frame):
    rows = [(1, 0, "a", None), (1, 0, "a", "first words of all here"), (1, 1, "b", "> first words of all here\nyes"), (1, 1, "b", "> first words of all here\nyes"),
            (1, 1, "c", "no quote"), (None, 0, "a", "words of nobody at all"), (None, 2, "b", "> words of nobody at all"), (1, None, "d", "> first words of all here"),
            (3, 0, "a", ""), (3, 1, "a", ">"), (3, 2, "a", "> " + "long " * 50_000)]
    out = chat.linked(frame(rows, SCHEMA)).collect()
    assert len(out) == len(rows)
    replies = sorted((r.conv_id or -1, -1 if r.turn is None else r.turn, r.reply_to) for r in out if r.reply_to is not None)
    assert replies == [(-1, 2, 0), (1, 1, 0), (1, 1, 0)]
    assert all(r.text is None or not r.text.startswith(">") for r in out)
    clash = frame([(1, 0, "a", "x", "y")], "conv_id long, turn long, role string, text string, path string", 1)
    assert [r.path for r in chat.linked(clash).collect()] == [[0]]
    assert chat.conversations(frame([], SCHEMA, 1)).count() == 0


def test_short_lines_are_linked(frame):
    rows = [(1, 0, "a", "ok\nthanks a lot for this\nbye"), (1, 1, "b", "yes\nno\nok"), (1, 2, "c", "> no\nreally"), (1, 3, "d", "> yes\n> no\nwhich"),
            (1, 4, "a", "is it\nyes\nso it is here"), (1, 5, "b", "> ok\nfine"), (1, 6, "b", "> is it\n> yes\nhm"), (1, 7, "b", "> thanks a lot for this\n> yes\nwell"),
            (1, 8, "c", "你好\n谢谢\n再见"), (1, 9, "d", "> 谢谢\n不客气")]
    got = by_turn(chat.linked(frame(rows, SCHEMA)))
    assert {t: got[1, t].reply_to for t in (2, 3, 5, 6, 7, 9)} == {2: 1, 3: 1, 5: 0, 6: 4, 7: 0, 9: 8}
    assert all(got[1, t].n_linked == 1 for t in (2, 3, 5, 6, 7, 9))
