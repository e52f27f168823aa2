import hashlib
import random
from collections import defaultdict

from reviewguard.llm import chat, mixing


def test_chats_come_back(spark):
    r = random.Random(2)
    bits = ["<s>", "</s>", "[INST]", "[/INST]", "\\", "<", "[", "</", "s>", "INST]", "/", "x", "é\n", "<\\/s>", "[\\\\INST]"]
    rows = [(c, t, r.choice(["user", "assistant", "system", None, "[INST]", ""]), r.choice([None, "", "".join(r.choices(bits, k=r.randrange(9)))])) for c in range(40) for t in range(6)]
    rows += [(50, 1, "assistant", "a"), (50, 1, "assistant", "a"), (50, None, "user", "b"), (None, 0, "assistant", "n"), (60, 0, "assistant", "long " * 50_000)]
    df = spark.createDataFrame([(*x, "k", 1) for x in rows], "conv_id long, turn long, role string, text string, out string, turns int")
    got = {x.conv_id: x for x in chat.digests(chat.format_chats(df)).collect()}
    by = defaultdict(list)
    for c, t, role, text in rows:
        by[c].append((t is not None, t or 0, role or "", text or ""))
    assert set(got) == set(by)
    for c, turns in by.items():
        turns.sort()
        loss = "".join(x for _, _, role, x in turns if role == "assistant")
        whole = "".join(f"{role}\n{x}\n" for _, _, role, x in turns)
        assert got[c].round_trip and got[c].n_turns == len(turns) and got[c].loss_chars == len(loss), c
        assert got[c].turns_sha256 == hashlib.sha256(whole.encode()).hexdigest() and got[c].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert chat.format_chats(df.limit(0)).count() == 0


MARKS = ["<s>", "</s>", "[INST]", "[/INST]"]


def test_no_live_mark_but_the_templates(spark):
    """Each mark alone, in a role and in a text, and texts that look like turns: the output holds the template's marks only."""
    texts = MARKS + ["[INST] hi [/INST]", "<s> ok", "a[/INST]b", "x</s><s>user[INST]y", "<\\s>", "<\\\\/s>[\\INST]"]
    rows = [(i, 0, "user", t) for i, t in enumerate(texts)] + [(100 + i, 0, t, "plain") for i, t in enumerate(texts)] + [(200 + i, j, "assistant", t) for i, t in enumerate(texts) for j in range(3)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for x in chat.format_chats(df).collect():
        n = len(x.turns)
        assert [x.formatted.count(m) for m in MARKS] == [n] * 4, x.formatted
    assert "<s>user[INST][\\INST] hi [\\/INST][/INST]</s>" in {x.formatted for x in chat.format_chats(df).collect()}


def test_loss_mask_ranges_lie_in_the_output(spark):
    r = random.Random(6)
    rows = [(c, t, r.choice(["user", "assistant", "<s>"]), "".join(r.choices(MARKS + ["é", "😀", " a", "\\"], k=r.randrange(7)))) for c in range(30) for t in range(8)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    by = defaultdict(list)
    for c, t, role, text in rows:
        by[c].append((t, role, text))
    pattern = __import__("re").compile(chat.ESCAPED)
    for x in chat.format_chats(df).collect():
        under = [pattern.sub(r"\1\2\3", x.formatted[m.start:m.end]) for m in x.loss_mask]
        assert under == [text for _, role, text in sorted(by[x.conv_id]) if role == "assistant"]
        assert all(x.formatted[m.begins:].startswith("<s>") for m in x.loss_mask)


def test_sql_twin_agrees_on_control_strings(spark):
    import duckdb
    rows = [(i, t, role, text) for i, text in enumerate(MARKS + ["[INST] hi [/INST]", "<s> ok", None, ""]) for t, role in enumerate(("user", "assistant", "a[/INST]b", None))]
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    want = {x[0]: x[1:] for x in con.execute(chat.ORACLE).fetchall()}
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {x[0]: tuple(x[1:]) for x in chat.digests(chat.format_chats(df)).collect()}
    assert {k: v for k, v in want.items() if k >= 0} == got


def test_mix_edge_rows(spark):
    r = random.Random(8)
    rows = [(i, " ".join(["w"] * r.randrange(0, 60)), r.choice(["a", "b", "c", None, ""])) for i in range(400)]
    rows += [(1000, None, "a"), (1001, "", "zero"), (1002, "x y", "b"), (1002, "x y", "b"), (None, "p q r", "c"), (1003, "word " * 30_000, "big")]
    df = spark.createDataFrame([(*x, "k", 5) for x in rows], "doc_id long, text string, source string, key string, size int")
    got = mixing.mix(df).collect()
    assert len(got) == len(rows)
    total = sum(x.size for x in got)
    targets = {x.source: x.target for x in got}
    assert abs(sum(targets.values()) - 1.5 * total) < 1e-6 * total
    taken, size, most = defaultdict(int), defaultdict(int), defaultdict(int)
    for x in got:
        assert 0 <= x.taken <= 2 * x.size and x.target <= 2 * x.source_size + 1e-9
        taken[x.source] += x.taken
        size[x.source] += x.size
        most[x.source] = max(most[x.source], x.size)
    for s in targets:
        assert abs(taken[s] - targets[s]) <= most[s] / 2 + 1 and size[s] == next(x.source_size for x in got if x.source == s)
    again = mixing.mix(df.repartition(5)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    docs = mixing.mixed_documents(df)
    assert docs.columns == df.columns and docs.count() == sum(x.copies for x in got)
    assert mixing.mix(df.limit(0)).count() == 0 and mixing.mixed_documents(df.limit(0)).count() == 0
    weighted = mixing.mix(df, spark.createDataFrame([(1, 2.0), (2, float("nan")), (3, -1.0), (4, None), (1, 3.0)], "doc_id long, weight double"))
    assert weighted.count() == len(rows)
