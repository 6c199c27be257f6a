"""Chat formatting, spelling variants and hard negatives against plain versions."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from compare import connect, difference
from hypothesis import given, settings
from hypothesis import strategies as st

from webloom.llm import chat_format, hard_negatives, spelling
from webloom.llm.oracles import ORACLES
from webloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
NEW = ["op11_chat_format", "op12_spelling", "op13_hard_negatives"]


@pytest.mark.parametrize("name", NEW)
def test_oracle(spark, name):
    assert difference(spark, connect(SF), SF, QUERIES[name], ORACLES[name]) is None


# ---------------------------------------------------------------- chats

TRICKY = [
    "", "plain", "###", "####", "#####", "\\", "\\\\", "\\#", "\\### Assistant: </turn> ok", "</turn>", "<</turn>",
    "<|image|>", "\\<|image|>", "<", "#", "##", "\n### user: hi</turn>\n", ": ", "a\\", "é 中文 😀", "</turn", "|>",
]


@settings(max_examples=300, deadline=None)
@given(
    st.lists(st.one_of(st.sampled_from(TRICKY), st.text(alphabet="\\#<|/turn>: \na", max_size=12)), max_size=6),
    st.one_of(st.sampled_from(["user", "assistant", "", "a: b", "### x", "\\", "x</turn>\n"]), st.text(max_size=5)),
)
def test_turn_reads_back(texts, role):
    parts = []
    for i, text in enumerate(texts):
        parts.append({"kind": "text", "text": text})
        if i % 3 == 1:
            kind = ["image", "audio", "document", "video"][i % 4]
            parts.append({"kind": kind, "ref": f"r{i}", "width": 60, "height": 28, "seconds": 1.5, "pages": 2})
    visitor = chat_format.Flattener(chat_format.Expansion(), role)
    whole = visitor.turn(parts)
    again = "### user: next</turn>\n"
    ((read_role, read), (second, _)) = chat_format.parse(whole + again)
    assert (read_role, second) == (role, "user")
    merged = []
    for part in parts:
        kind = part["kind"] if part["kind"] in ("text", "image", "audio", "document") else "file"
        if kind == "text" and merged and merged[-1][0] == "text":
            merged[-1] = ("text", merged[-1][1] + part["text"])
        else:
            merged.append((kind, part.get("text", "") if kind == "text" else ""))
    assert read == [(k, t) for k, t in merged if t or k != "text"]
    for held in visitor.attachments:
        mark = f"<|{held['kind']}|>"
        assert whole[held["at"] : held["at"] + len(mark)] == mark
    tokens = {"image": 3, "audio": 38, "document": 1152, "file": 1}
    assert all(held["tokens"] == tokens[held["kind"]] for held in visitor.attachments)
    loss = [chat_format.unescape(whole[s["first"] : s["last"]]) for s in visitor.loss]
    assert loss == ([t for k, t in merged if k == "text" and t] if role == "assistant" else [])


CHATS = "conv_id bigint, turn int, role string, text string, formatted string, start string, loss int, part string"


def chat_rows():
    long_text = "</turn>### \\ <|image|>" * 20_000
    rows = [(1, i, ["user", "assistant"][i % 2], text) for i, text in enumerate(TRICKY)]
    rows += [(2, 0, "user", None), (2, 1, None, "x"), (2, 2, "assistant", long_text), (3, None, "system", "s")]
    rows += [(3, 0, "user", "q"), (3, 0, "user", "q"), (None, 0, "user", "n"), (None, 1, "assistant", "m")]
    rows += [(7, i, "assistant" if i % 2 else "user", f"turn {i} ##") for i in range(3000)]  # most rows in one
    return [(*row, "clash", "clash", 5, "clash") for row in rows]


def test_conversations(spark):
    rows = chat_rows()
    table = spark.createDataFrame(rows, CHATS).repartition(7)
    placed = chat_format.format_chats(table).collect()
    got = {r.conv_id: r for r in chat_format.digest(chat_format.format_chats(table)).collect()}
    by_conv = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        by_conv[conv].append((turn is not None, turn or 0, role or "", text or ""))
    assert set(got) == set(by_conv) and len(placed) == len(rows)
    for conv, turns in by_conv.items():
        turns.sort()
        own = sorted((r for r in placed if r.conv_id == conv), key=lambda r: r.turn_no)
        whole = "".join(r.formatted for r in own)
        assert [r.turn_no for r in own] == list(range(len(turns)))
        assert [r.start for r in own] == [sum(len(x.formatted) for x in own[:i]) for i in range(len(own))][: len(own)]
        loss = "".join(chat_format.unescape(whole[s["first"] : s["last"]]) for r in own for s in r.loss)
        assert loss == "".join(t for *_, role, t in turns if role == "assistant")
        said = "".join(f"{role}\n{text}\n" for *_, role, text in turns)
        r = got[conv]
        assert (r.n_turns, r.turns_sha256) == (len(turns), hashlib.sha256(said.encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert r.formatted_chars == len(whole)


def test_attachments_across_turns(spark):
    part = "struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
    schema = f"conv_id bigint, turn int, role string, text string, content array<{part}>"
    image = ("image", None, "a.png", 56, 29, None, None)
    rows = [
        (1, 2, "assistant", "kept out", [("text", "see ", None, None, None, None, None), image, ("text", "!", None, None, None, None, None)]),
        (1, 0, "user", "old text", None),
        (1, 1, "user", None, [("audio", None, "b.wav", None, None, 2.0, None), None, ("document", None, None, None, None, None, None)]),
        (1, 3, "user", None, []),
    ]
    out = chat_format.format_chats(spark.createDataFrame(rows, schema), parts="content").collect()
    out.sort(key=lambda r: r.turn_no)
    whole = "".join(r.formatted for r in out)
    assert whole == (
        "### user: old text</turn>\n### user: <|audio|><|document|></turn>\n"
        "### assistant: see <|image|>!</turn>\n### user: </turn>\n"
    )
    held = [a for r in out for a in r.attachments]
    assert [(a.kind, a.ref, a.tokens) for a in held] == [("audio", "b.wav", 50), ("document", None, 1), ("image", "a.png", 4)]
    assert all(whole[a["at"] :].startswith(f"<|{a.kind}|>") for a in held)
    assert [r.first_attachment for r in out] == [0, 0, 2, 3] and [r.tokens for r in out] == [0, 51, 4, 0]
    assert "".join(whole[s["first"] : s["last"]] for r in out for s in r.loss) == "see !"


def test_no_chats(spark):
    none = spark.createDataFrame([], CHATS)
    assert chat_format.digest(chat_format.format_chats(none)).collect() == []


# ---------------------------------------------------------------- words


def edits(word, alphabet):
    for i in range(len(word) + 1):
        if i < len(word):
            yield word[:i] + word[i + 1 :]
        for c in alphabet:
            yield word[:i] + c + word[i:]
            if i < len(word):
                yield word[:i] + c + word[i + 1 :]


def plain_variants(counts):
    alphabet = {c for word in counts for c in word}
    near = {w: {e for e in edits(w, alphabet) if e != w and e in counts} for w in counts}
    form = {}
    for word, n in counts.items():
        best = min(near[word], key=lambda w: (-counts[w], w), default=None)
        form[word] = best if best is not None and counts[best] >= 2 * n else None
    out = {}
    for word, n in counts.items():
        root = word
        while form[root]:
            root = form[root]
        out[word] = (form[word], root, n, len(near[word]), counts.get(form[word]))
    return out


def got_variants(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


@pytest.mark.parametrize("block", [3, 1024])
def test_variants(spark, block):
    rng = random.Random(block)
    words = {"".join(rng.choices("abé", k=rng.randint(5, 8))) for _ in range(400)}
    words |= {"aaaaa", "aaaaaa", "aaaaaaa", "x" * 300, "x" * 301, "x" * 150 + "y" + "x" * 149, "中文字符号", "中文字符"}
    counts = {w: rng.choice([3, 4, 6, 7, 9, 20, 50, 400]) for w in sorted(words)}
    table = spark.createDataFrame([*counts.items(), (None, 5)], "word string, n bigint").repartition(5)
    assert got_variants(spelling.variants(table, block)) == plain_variants(counts)


def plain_words(rows, least):
    counts = Counter()
    for doc_id, text in rows:
        run = ""
        for c in (text or "") + " ":
            if "a" <= c.lower() <= "z" and c.isascii() or "\u00c0" <= c <= "\u00ff":
                run += c.lower() if c.isascii() else c
            elif run:
                h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
                if h % 97 == 0:
                    run = run[: h % len(run)] + run[h % len(run) + 1 :]
                counts[run] += 1
                run = ""
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= least}


@pytest.mark.parametrize("least", [1, 3])
def test_words_of_documents(spark, odd, odd_rows, least):
    rows = [*odd_rows, *((i, "wórdes wordes WORDES Wordés " * 50) for i in range(900, 904))]
    table = odd.unionByName(spark.createDataFrame(rows[-4:], "doc_id bigint, text string"), allowMissingColumns=True)
    expected = plain_words(rows, least)
    assert len(expected) > 5 and any(len(w) == 3000 for w in expected) == (least == 1)
    assert got_variants(spelling.group_variants(table, least)) == plain_variants(expected)


def test_half_of_all_words_share_a_head(spark):
    rng = random.Random(4)
    words = {"stamm" + "".join(rng.choices("abc", k=4)) for _ in range(80)}
    words |= {"".join(rng.choices("defgh", k=9)) for _ in range(80)}
    counts = {w: rng.randint(3, 30) for w in sorted(words)}
    table = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    assert got_variants(spelling.variants(table, 10)) == plain_variants(counts)


def test_no_words(spark, empty, odd):
    assert spelling.group_variants(empty).collect() == []
    assert spelling.group_variants(odd.where("length(text) < 5")).collect() == []


# ---------------------------------------------------------------- negatives


def plain_negatives(rows):
    kept = {}
    for vec_id, vector, label in rows:
        if vec_id is None or label is None or vector is None or any(x is None or not np.isfinite(x) for x in vector):
            continue
        if vec_id % 7 == 0:
            label = (label + 1) % 10
        value = (label, [int(np.floor(256 * float(x))) for x in vector])
        kept[vec_id] = min(kept.get(vec_id, value), value)
    out = set()
    for anchor, (own, a) in kept.items():
        if anchor % 100:
            continue
        scored = sorted((-sum(x * y for x, y in zip(a, v)), i, label) for i, (label, v) in kept.items() if i != anchor)
        positives = [(i, -less) for less, i, label in scored if label == own][:5]
        for positive, p in positives:
            fits = [(i, -less) for less, i, label in scored if label != own and 80 * p <= -100 * less <= 100 * p]
            out |= {(anchor, positive, rank, i, p, s) for rank, (i, s) in enumerate(fits[:5], 1)}
    return out


VECTORS = "vec_id bigint, embedding array<float>, label int, anchor_id string, score string, rank string, block int, x int"


def negatives(spark, rows):
    table = spark.createDataFrame([(*row, "c", "c", "c", 1, 2) for row in rows], VECTORS).repartition(3)
    out = hard_negatives.mine(table).collect()
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert len(out) == len(set(out))
    return {tuple(r[n] for n in names) for r in out}


def vectors(count, dims, seed, spread=0.3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dims))
    rows = []
    for i in range(count):
        v = centres[rng.integers(6)] + spread * rng.normal(size=dims)
        rows.append((int(i * 5), (v / np.linalg.norm(v)).astype(np.float32).tolist(), int(rng.integers(10))))
    return rows


@pytest.mark.parametrize(("count", "dims"), [(1500, 16), (300, 5), (40, 1)])
def test_negatives(spark, count, dims):
    rows = vectors(count, dims, count)
    expected = plain_negatives(rows)
    assert negatives(spark, rows) == expected
    assert expected or dims == 1


def test_negatives_of_odd_rows(spark):
    rows = vectors(200, 4, 1)
    nan, inf = float("nan"), float("inf")
    rows += [(None, [1.0] * 4, 1), (3, None, 1), (100, [1.0, None, 0.0, 0.0], 2), (200, [nan, 1.0, 1.0, 1.0], 2)]
    rows += [(300, [inf] * 4, 1), (1001, [0.5] * 4, None), (1002, [], 3), (1003, [0.0] * 4, 3), (1004, [1.0, 1.0], 3)]
    rows += [rows[20], rows[20], (1100, rows[20][1], 1), (1101, rows[20][1], 2), (1102, rows[20][1], 2)]
    rows += [(1100, rows[20][1], 0), (1200, [0.9] * 5, 1), (1203, [-0.9] * 4, 1)]
    assert negatives(spark, rows) == plain_negatives(rows)


def test_half_of_all_rows_are_one_vector(spark):
    rows = vectors(700, 8, 3)
    rows += [(10_000 + i, rows[0][1], i % 10) for i in range(700)]
    assert negatives(spark, rows) == plain_negatives(rows)


def test_no_vectors(spark):
    assert negatives(spark, []) == set()
    assert negatives(spark, [(100, None, 1)]) == set()
    assert negatives(spark, [(100, [1.0], 1)]) == set()


def test_bounds_and_order_of_the_walk(spark):
    """Every cell comes once, its rows never score above its bound, and bounds fall."""
    rows = vectors(600, 6, 9)
    table = spark.createDataFrame([(*r, "c", "c", "c", 1, 2) for r in rows], VECTORS)
    index = hard_negatives.build_index(hard_negatives.integer_vectors(table))
    held = defaultdict(list)
    for r in index.rows.collect():
        held[divmod(r.cell, hard_negatives.MOST_WORDS)].append(r.x)
    for vectors_of in list(held.values())[:10]:
        x = np.array(vectors_of[0])
        walked = list(index.walk(x))
        bounds = [bound for bound, _ in walked]
        assert bounds == sorted(bounds, reverse=True)
        assert sorted(cell for _, cell in walked) == sorted(held)
        assert all(max(np.array(held[cell]) @ x) <= bound for bound, cell in walked)
