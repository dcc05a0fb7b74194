"""Chat formatting and structure repair against plain Python, in one chunk and in many."""

import hashlib
import itertools
import json
import random
import zlib

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from pairweave.llm import chat_format as cf, structure_repair as sr
from pairweave.llm.queries import damaged
from pairweave.llm.turns import chunk_turns
from pairweave.session import rewrite

TURNS = "conv_id bigint, turn bigint, role string, text string"
ROLES = ["user", "assistant", "system", "tool", "", None]
TEXTS = ["Yes.", "No!", "cut", "", " \t", None, "a\nb?", "</turn>\n<turn user>", "\\", "é\U0001f600.", "### <|x|> \\\\"]


@pytest.fixture(scope="module")
def odd_turns(spark):
    """Nulls in every column, ties, repeated rows, one long conversation, a very long text, and columns that could clash."""
    rng = random.Random(5)
    rows = [(c, t, rng.choice(ROLES), rng.choice(TEXTS)) for c in (1, 2, None, 3, -7) for t in [None, None, 0, 1, 1, 2, 5, 9, 9, 9]]
    rows += [(50, i, rng.choice(ROLES[:3]), f"turn {rng.randrange(60)}{rng.choice('.!x')}") for i in range(300)]
    rows += [(51, i, "user", f"only users {i}.") for i in range(90)] + [(52, i, "system", f"only systems {i}") for i in range(90)]
    rows += [(53, i // 40, "user", "the same") for i in range(120)] + [(54, 0, "user", "long " * 200_000), (54, 1, "assistant", "x" * 300_000 + ".")]
    rng.shuffle(rows)
    clash = ["place", "part", "seq", "edge", "conv_key", "kind", "time", "codes", "fingerprint", "mapping", "span", "_slice"]
    return spark.createDataFrame(rows, TURNS).withColumns({c: F.lit("x") for c in clash})


def by_conversation(rows, said=lambda x: x):
    rows = sorted(rows, key=lambda r: (r.turn is not None, r.turn or 0, r.role is not None, (r.role or "").encode(), r.text is not None, (r.text or "").encode()))
    out = {}
    for r in rows:
        out.setdefault(r.conv_id, []).append((r.turn, said(r.role), said(r.text)))
    return out


@pytest.mark.parametrize("size", [(3, 1 << 20), (1024, 40), (1024, 1 << 20)])
def test_chunks_keep_every_row_in_order(odd_turns, size):
    found = {}
    chunks, _ = rewrite(chunk_turns(odd_turns, *size), "chunks")
    rows = sorted(chunks.collect(), key=lambda r: (r.part, r.seq))
    for r in rows:
        assert len(r.turns) <= size[0]
        found.setdefault(r.conv_id, []).extend(zip(r.turns, r.roles, r.texts))
    assert found == by_conversation(odd_turns.collect())
    alone = {r.conv_id for r in rows if not r.edge}
    assert all(sum(r.conv_id == c for r in rows) == 1 for c in alone)


# --- formatting


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.text(alphabet='\\<>/turn |#\n aé"', max_size=12), st.text(alphabet="\\<>/turn |#\n aé", max_size=25)), max_size=5))
def test_template_gives_back_what_it_was_given(turns):
    template = cf.Template()
    text, spans = template.format(turns)
    assert template.parse(text) == turns
    assert spans == []
    text, spans = template.format([("assistant", t) for _, t in turns])
    assert [template.unescape(text[a:b]) for a, b in spans] == [t for _, t in turns]


def test_parse_refuses_other_texts():
    for text in ("hello", "<turn user>no end", "<turn user>escaped \\</turn>\n"):
        with pytest.raises(ValueError):
            cf.Template().parse(text)


def digest_of(turns):
    said = "".join(f"{r}\n{t}\n" for r, t in turns)
    loss = "".join(t for r, t in turns if r == "assistant")
    return len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


@pytest.mark.parametrize("size", [(4, 1 << 20), (1024, 1 << 20)])
def test_formatted_conversations_are_read_back(odd_turns, size):
    written, _ = rewrite(cf.format_chats(cf.table_turns(odd_turns), cf.Template(), *size), "formatted")
    found = {r.conv_id: r for r in cf.chat_digest(written).collect()}
    wanted = by_conversation(odd_turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).collect())
    assert found.keys() == wanted.keys()
    for conv, rows in wanted.items():
        r, turns = found[conv], [(role, text) for _, role, text in rows]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == digest_of(turns)
        assert r.formatted_chars == len(cf.Template().format(turns)[0])


RECORDS = {
    "messages": ({"messages": [{"role": "user", "content": "q"}, {"role": "gpt", "content": "a"}], "score": 3}, [("user", "q"), ("assistant", "a")]),
    "messages_parts": ({"system": "s", "messages": [{"role": "user", "content": [{"type": "text", "text": "q"}, {"type": "text", "text": "r"}]}]}, [("system", "s"), ("user", "qr")]),
    "no_messages": ({"messages": [], "id": "x"}, []),
    "conversations": ({"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]}, [("user", "q"), ("assistant", "a")]),
    "prompt_completion": ({"prompt": "q", "completion": "a"}, [("user", "q"), ("assistant", "a")]),
    "prompt_response": ({"prompt": "q", "response": "a", "system": "s"}, [("system", "s"), ("user", "q"), ("assistant", "a")]),
    "instruction": ({"instruction": "do", "input": "this", "output": "done"}, [("user", "do\n\nthis"), ("assistant", "done")]),
    "question_answer": ({"question": "q", "answer": 7, "context": "c"}, [("user", "c\n\nq"), ("assistant", "7")]),
    "turn": ({"role": "user", "text": "t"}, [("user", "t")]),
}


def test_layouts_are_told_apart_by_their_paths(spark):
    rows = [(i, json.dumps(record)) for i, (record, _) in enumerate(RECORDS.values())]
    rows += [(100, json.dumps({"unknown": 1})), (101, "no json"), (102, None), (103, "[1]"), (104, json.dumps({"prompt": "q"}))]
    found = {}
    for r in cf.canonical_turns(spark.createDataFrame(rows, "conv_id bigint, record string")).collect():
        found.setdefault(r.conv_id, []).append(r)
    for i, (name, (_, turns)) in enumerate(RECORDS.items()):
        got = sorted(found.get(i, []), key=lambda r: r.turn)
        assert [(r.role, r.text) for r in got] == turns
        assert all(r.mapping == name for r in got)
    for i, raw in rows[len(RECORDS):]:
        assert [(r.mapping, r.role, r.text) for r in found[i]] == [(None, None, raw)]
    marks = [cf.hash_paths(cf.filled_paths(record) & cf.known_paths(cf.MAPPINGS)) for record, _ in RECORDS.values()]
    assert len(set(marks)) == len(marks)


def test_table_and_records_have_the_same_fingerprints(spark):
    rows = [(1, 0, "user", "a"), (1, 1, None, "b"), (1, 2, "user", None), (2, 0, None, None)]
    table = cf.table_turns(spark.createDataFrame(rows, TURNS)).collect()
    wanted = [cf.hash_paths({n for n, v in (("role", r), ("text", t)) if v is not None}) for _, _, r, t in rows]
    assert [r.fingerprint for r in table] == wanted
    assert [(r.role, r.text, r.mapping) for r in table] == [(r or "", t or "", "turn") for _, _, r, t in rows]


def test_two_mappings_of_one_layout_are_refused():
    with pytest.raises(ValueError):
        cf.registry([*cf.MAPPINGS, cf.mapping("again", "prompt completion", "", ("user", "prompt"))])


# --- repair


def faults_of(rows):
    seen, out = set(), []
    for _, role, text in rows:
        shown = text.strip(sr.BLANKS)
        out.append("blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows):
    """Least (cost, letters) with the repaired turns, forwards, over every edit."""
    best = {"": (0, "", ())}
    fits = {"": "u", "s": "u", "u": "a", "a": "u"}
    full = {"u": "user", "a": "assistant"}

    def inserted(best):
        for _ in range(2):
            for state, (cost, letters, turns) in list(best.items()):
                new = fits[state]
                best[new] = min(best.get(new, (1 << 30,)), (cost + 2, letters + "I", (*turns, (full[new], ""))))
        return best

    for (_, role, text), fault in zip(rows, faults_of(rows)):
        after = {}
        for state, (cost, letters, turns) in inserted(dict(best)).items():
            options = [(state, 3, "D", turns)]
            if fault not in ("blank", "duplicate"):
                cut = int(fault == "truncated")
                options.append((fits[state], 2 + cut, "R", (*turns, (full[fits[state]], text))))
                if role[:1] == fits[state] or state == "" and role[:1] == "s":
                    options.append((role[:1], cut, "K", (*turns, (role, text))))
            for new, more, letter, said in options:
                after[new] = min(after.get(new, (1 << 30,)), (cost + more, letters + letter, said))
        best = after
    return min(v for k, v in inserted(best).items() if k in ("", "a"))


def report_of(rows):
    initials = [role[:1] for _, role, _ in rows]
    numbers = [t for t, _, _ in rows if t is not None]
    cost, letters, turns = cheapest(rows)
    faults = faults_of(rows)
    return (
        max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
        sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials)), cost, letters,
        hashlib.sha256("\n".join(f"{r}:{t}" for r, t in turns).encode()).hexdigest(),
    )


def reported(df):
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in df.collect()}


blank = lambda v: " " if v is None else v


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool", ""]), st.sampled_from(["a.", "b.", "c", "d", "", "e!"])), max_size=9))
def test_edits_are_the_cheapest_and_least(rows):
    codes, _ = sr.codes_of([r for r, _ in rows], [t for _, t in rows])
    costs = sr.vectors(codes, sr.END)
    audit, state, cost = sr.trace(codes, costs, 0)
    audit, cost = audit + sr._TAIL[state], cost + 2 * len(sr._TAIL[state])
    turns = sr.apply_edits(audit, 0, [r for r, _ in rows], [t for _, t in rows])
    assert (cost, audit, tuple(zip(*turns))) == cheapest([(0, r, t) for r, t in rows])


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=40).map(lambda b: bytes(c % 10 for c in b)), st.integers(0, 40), st.sampled_from([(0, 4, 2, 0), (0, 0, 0, 0), (2, 0, 1, 2)]))
def test_a_second_run_meets_the_first(codes, at, other):
    first = sr.run_back(codes, sr.END)
    assert sr.run_back(codes, other, (sr.END, first)) == sr.run_back(codes, other) == sr.vectors(codes, other)[0]
    # Cut anywhere, the parts give the same vector.
    assert sr.run_back(codes[:at], sr.run_back(codes[at:], other)) == sr.run_back(codes, other)


@pytest.mark.parametrize("size", [(5, 1 << 20, 2), (64, 1 << 20, 1), (1024, 1 << 20, 4096)])
def test_repair_of_odd_conversations(odd_turns, size):
    wanted = {c: report_of(rows) for c, rows in by_conversation(odd_turns.collect(), blank).items() if c != 54}
    found = reported(sr.repair_report(*sr.repair_parts(odd_turns, *size)))
    long = found.pop(54)
    assert long[5] == 1 and long[6] == "KK"
    assert found == wanted


def test_repair_after_damage(spark, odd_turns):
    rows = spark.createDataFrame([(c, t, ROLES[(c + t) % 2], f"turn {t}.") for c in range(60) for t in range(9)], TURNS)
    kinds = {(c, t): zlib.crc32(f"{c}:{t}".encode()) % 20 for c in range(60) for t in range(9)}
    after = by_conversation(damaged(rows).collect())
    for c in range(60):
        wanted = []
        for t in range(9):
            k, role, text = kinds[c, t], ROLES[(c + t) % 2], f"turn {t}."
            one = (t, "user" if k == 4 else role, "" if k == 1 else f"turn {t}" if k == 2 else text)
            wanted += [one] * (0 if k == 0 else 2 if k == 3 else 1)
        assert after.get(c, []) == wanted
    assert damaged(odd_turns).filter("role is null or text is null").count() == 0


def test_empty_tables(spark, odd_turns):
    none = odd_turns.filter("false")
    assert sr.repair_report(*sr.repair_parts(none)).collect() == []
    assert sr.repair_conversations(none).collect() == []
    assert cf.chat_digest(cf.format_chats(cf.table_turns(none))).collect() == []
    assert cf.canonical_turns(spark.createDataFrame([], "conv_id bigint, record string")).collect() == []
