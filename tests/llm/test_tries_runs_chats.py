"""Prefix tries, periodic runs and chat formatting against brute force, exact round trips and awkward rows."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from trendloom.llm import chat, prefix_trie, runs, workload

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
CHATS = "conv_id long, turn long, role string, text string, key string, n long"


@pytest.fixture(scope="module")
def chats(spark):
    """NULLs in every column, ties, repeated rows, a hot first turn, whole copies, turnless and long conversations."""
    rng = random.Random(2)
    rows = []
    for conv in [*range(60), 1000, 1003, -4, -7]:
        turns = [("system", "be kind")] if conv % 3 == 0 else []
        turns += [(rng.choice(["user", "assistant"]), rng.choice(["a", "é b", "<|im_end|>", "", "x\ny"])) for _ in range(rng.randrange(1, 7))]
        rows += [(conv, i, r, t, "k", 1) for i, (r, t) in enumerate(turns)]
    rows += [(70 + c, i, "user", "same", None, None) for c in range(20) for i in range(3)]
    rows += [(200, i, "user", f"turn {i}", None, None) for i in range(700)]
    rows += [(201, None, None, None, "k", 2), (201, None, "user", None, "k", 2), (201, 3, None, "t", "k", 2), (201, 3, None, "t", "k", 2)]
    rows += [(None, 1, "assistant", "nobody's", "k", 2), (None, None, None, None, None, None)]
    return spark.createDataFrame(rows, CHATS)


def _ordered(chats):
    """Each conversation's turns; ties by digest, as the trie takes them."""
    found = collections.defaultdict(list)
    for r in chats.collect():
        if r.conv_id is not None:
            role, text = r.role or "", r.text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            found[r.conv_id].append((r.turn is not None, r.turn or 0, digest, (role, text)))
    return {c: [t[-1] for t in sorted(v)] for c, v in found.items()}


def _trie(sequences):
    """Every beginning as a plain tuple."""
    members = collections.defaultdict(list)
    for conv, turns in sequences.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(conv)
    children = collections.Counter(k[:-1] for k in members if k)
    want = []
    for k, convs in members.items():
        below = [n for n in members if n[: len(k)] == k]
        saved = sum((len(members[n]) - 1) * len(n[-1][1].encode()) for n in below if n)
        ends = ",".join(str(c) for c in sorted(convs) if len(sequences[c]) == len(k))
        want.append((min(convs), len(k), min(members[k[:-1]]) if k else None, len(convs), children[k],
                     sum(children[n] == 0 for n in below), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(want, key=str)


@pytest.mark.parametrize("nodes", [8, 1 << 18])
def test_trie_of_rebuilt_conversations(spark, chats, tmp_path, monkeypatch, nodes):
    """With batches of a few nodes and with one batch a task."""
    monkeypatch.setattr(prefix_trie, "BATCH_NODES", nodes)
    monkeypatch.setattr(prefix_trie, "CHUNK", 5)
    chats.repartition(7).write.parquet(str(tmp_path / "conversations.parquet"))
    own = _ordered(chats)
    rebuilt = {}
    for c, turns in own.items():
        h, base = zlib.crc32(str(c).encode()) % 9, int(c / 5) * 5
        rebuilt[c] = own.get(base, [])[:h] + turns[h:]
    assert any(not t for t in rebuilt.values())
    got = workload.op11_prefix_trie(spark, str(tmp_path))
    assert sorted(map(tuple, got.collect()), key=str) == _trie(rebuilt)


def test_trie_of_plain_conversations(spark, chats):
    paths = prefix_trie.paths_of(prefix_trie.turn_groups(chats), prefix_trie.as_they_are)
    assert sorted(map(tuple, prefix_trie.prefix_trie(paths).collect()), key=str) == _trie(_ordered(chats))
    none = prefix_trie.paths_of(prefix_trie.turn_groups(chats.limit(0)), prefix_trie.as_they_are)
    assert prefix_trie.prefix_trie(none).count() == 0


def test_fat_search_takes_few_look_ups():
    """A path of 4,096 nodes is searched in a number of look-ups that grows with its logarithm."""

    class Counted(dict):
        asked = 0

        def get(self, *args):
            Counted.asked += 1
            return super().get(*args)

    trie = prefix_trie.ZFastTrie()
    keys = [bytes([7]) + i.to_bytes(15, "big") for i in range(1 << 12)]
    for n in range(1, len(keys) + 1):
        trie.insert(keys[:n], [1] * n, n, 0, 0)
    trie.handles = Counted(trie.handles)
    assert trie.exit_node(keys)[1] == -1 and Counted.asked <= 13
    assert [prefix_trie.two_fattest(a, b) for a, b in ((0, 7), (4, 7), (6, 7), (3, 12), (8, 9))] == [4, 6, 7, 8, 9]


def _plain_runs(words):
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = q
        while i < n:
            if words[i] != words[i - q]:
                i += 1
                continue
            j = i
            while j < n and words[j] == words[j - q]:
                j += 1
            start, length = i - q, j - i + q
            if length >= max(6, 4 * q) and (start, length) not in found:
                found[start, length] = q
            i = j
    return sorted((s, n, q) for (s, n), q in found.items())


def _repetitive(rng, n):
    words = []
    while len(words) < n:
        piece = [rng.choice("abc") for _ in range(rng.randrange(1, 9))]
        words += piece * rng.randrange(1, 7) + piece[: rng.randrange(len(piece))]
    return words[:n]


def test_runs_are_those_of_plain_search(spark):
    rng = random.Random(5)
    texts = [" ".join(_repetitive(rng, rng.randrange(0, 150))) for _ in range(300)]
    texts += [" ".join(rng.choice("ab") for _ in range(200)) for _ in range(40)]
    texts += [None, "", " \n ", "one", "a " * 6, "a " * 5, "x y " * 20000, "é" + "\tz\x0b" * 9, "\x1fa \x1fa a " * 6, texts[0], texts[0]]
    docs = spark.createDataFrame([(None if i % 50 == 9 else i, t, 1, "r") for i, t in enumerate(texts)], "doc_id long, text string, runs long, row string")
    got = runs.periodic_runs(docs)
    assert got.count() == len(texts)
    checked = collections.Counter()
    for r in got.collect():
        words = WORDS.findall(r.row.text or "")
        found = [tuple(x) for x in r.runs]
        if len(words) < 1000:
            assert found == _plain_runs(words)
        kept = [w for i, w in enumerate(words) if not any(s + q <= i < s + n for s, n, q in found)]
        assert r.collapsed == " ".join(kept) and r.n_words == len(words) and r.row.runs == 1
        order = sorted(found, key=lambda x: (-x[1] / x[2], x[0], x[2]))
        assert (tuple(r.best) if r.best else None) == (order[0] if order else None)
        checked[len(found) > 0] += 1
    assert min(checked.values()) > 10
    assert [tuple(x) for x in got.filter("row.text LIKE 'x y x y%'").first().runs] == [(0, 40000, 2)]
    assert runs.periodic_runs(docs.limit(0)).count() == 0


def test_one_lag_a_scale_however_often_a_word_occurs():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 2, 50_000).astype(np.uint64)
    hits = list(runs.occurrences(words, np.zeros(len(words), np.int64), np.zeros(1, np.int64)))
    assert all(len(np.unique(at)) == len(at) <= len(words) for _, at, _ in hits) and len(hits) < 27


def test_documents_with_periods(spark):
    docs = spark.createDataFrame([(i, " ".join(f"w{i}x{j}" for j in range(i % 90))) for i in range(400)] + [(None, "a b"), (7, None)], "doc_id long, text string")
    for r in workload._with_periods(docs).collect():
        words = [f"w{r.doc_id}x{j}" for j in range(r.doc_id % 90)] if r.doc_id is not None and r.text is not None else []
        n, crc = len(words), zlib.crc32(str(r.doc_id).encode())
        if r.doc_id is not None and crc % 10 == 0 and n:
            g = crc // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
        assert WORDS.findall(r.text or "") == (words if r.doc_id is not None else ["a", "b"])


def test_any_content_comes_back():
    rng = random.Random(1)
    bits = ["<|im_end|>", "<|im_start|>", "<|", "|>", "\\", "im_end", "nl", "<|nl|>", "\n", "a", "<|\\im_end|>", "<|\\\\nl|>", "assistant", "<|endoftext|>"]
    for _ in range(3000):
        turns = [("".join(rng.choices(bits, k=rng.randrange(4))), "".join(rng.choices(bits, k=rng.randrange(6)))) for _ in range(rng.randrange(5))]
        written = chat.render(turns)
        parsed = chat.parse(written)
        assert [t[:2] for t in parsed] == turns
        assert [chat.unescape(written[s:e]) for *_, s, e in parsed] == [t[1] for t in turns]


def test_plain_content_is_not_touched():
    assert chat.render([("user", "a \\ <| b |>"), ("assistant", "<|nl|>")]) == "<|im_start|>user\na \\ <| b |><|im_end|>\n<|im_start|>assistant\n<|nl|><|im_end|>\n"


@pytest.mark.parametrize("text", ["x", "<|im_start|>user", "<|im_start|>user\nhi", "<|im_start|>u\nhi<|im_end|>", "<|im_start|>u\nhi<|im_start|>v\n<|im_end|>\n"])
def test_what_the_grammar_refuses(text):
    assert chat.parse(text) is None


def test_chats(spark, chats):
    got = {r.conv_id: r for r in chat.read_back(chat.format_chats(chats.repartition(5))).collect()}
    want = collections.defaultdict(list)
    for r in chats.collect():
        want[r.conv_id].append(((r.turn is not None, r.turn or 0), (r.role or "", r.text or "")))
    assert set(got) == set(want)
    for conv, turns in want.items():
        turns = [t[1] for t in sorted(turns)]
        assert [tuple(t) for t in got[conv].turns] == turns
        assert got[conv].loss_text == "".join(t for r, t in turns if r == "assistant")
    assert chat.format_chats(chats.limit(0)).count() == 0


def test_planted_conversation(spark):
    row = workload.op13_chat_formatting(spark, "/root/testdata/sf0.001").filter("conv_id = -1").first()
    assert row.n_turns == 2 and row.loss_chars == len(workload.HOSTILE)
    assert row.loss_sha256 == hashlib.sha256(workload.HOSTILE.encode()).hexdigest()
