"""Conversation tries, URL models and periodic runs beside plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from compare import differences, duck
from hypothesis import given, settings
from hypothesis import strategies as st

from parcelpulse.llm import conversation_trie, periodic_runs, url_models
from parcelpulse.llm.common import table
from parcelpulse.llm.oracles import ORACLES
from parcelpulse.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def sha(text):
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


# Conversation tries


def rebuilt(rows):
    stored = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            stored[conv].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [(r, t) for _, _, r, t in sorted(found, key=lambda x: x[:3])] for c, found in stored.items()}
    out = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = turns.get(c - c % 100, [])[:h] + own[h:]
    return out


def plain_trie(rows):
    convs = rebuilt(rows)
    members = defaultdict(list)
    for c in sorted(convs):
        for d in range(len(convs[c]) + 1):
            members[tuple(convs[c][:d])].append(c)
    children = Counter(node[:-1] for node in members if node)
    leaves, saved = Counter(), Counter()
    for node, found in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += children[node] == 0
            saved[node[:d]] += (len(found) - 1) * len(node[-1][1]) if node else 0
    return sorted(
        (
            found[0],
            len(node),
            members[node[:-1]][0] if node else None,
            len(found),
            children[node],
            leaves[node],
            saved[node],
            sha(",".join(str(c) for c in found if len(convs[c]) == len(node))),
        )
        for node, found in members.items()
    )


TRIE = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def trie_rows(df):
    return sorted(tuple(r[c] for c in TRIE) for r in conversation_trie.conversation_trie(df).collect())


def nodes_of(rows):
    return sorted(rows, key=lambda r: (r[1], r[0]))


CONVERSATIONS = "conv_id long, turn long, role string, text string"


def test_trie_equals_plain_python(spark):
    stored = [tuple(r) for r in table(spark, SF_DIR, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert trie_rows(table(spark, SF_DIR, "conversations")) == plain_trie(stored)


def test_trie_of_shared_and_odd_conversations(spark):
    rng = random.Random(5)
    rows = []
    for conv in [*range(0, 60), *range(100, 140), 205, 300, 2**40]:
        length = 40 if conv == 7 else rng.randint(1, 8)
        for turn in range(length):
            rows.append((conv, turn, rng.choice(["user", "assistant"]), rng.choice(["", "a", "bc", "ü😀"])))
    rows += [(310, None, None, None), (310, 0, "user", "a"), (311, 3, "user", None), (311, 3, "user", None)]
    rows += [(None, 0, "user", "lost"), (300, 5, None, "x" * 50_000)]
    df = spark.createDataFrame([(*r, 1, "extra") for r in rows], CONVERSATIONS + ", depth int, f1 string")
    expected = plain_trie(rows)
    assert trie_rows(df) == expected
    assert trie_rows(df.repartition(5)) == expected


def test_one_conversation_over_many_tasks(spark):
    """Most rows belong to one conversation: its sums cross task borders."""
    rows = [(7, k, "user", f"turn {k % 50}") for k in range(3_000)] + [(8, k, "user", f"turn {k}") for k in range(5)]
    rows += [(0, k, "user", f"turn {k}") for k in range(6)]
    df = spark.createDataFrame(rows, CONVERSATIONS).repartition(4)
    found = {r[:2]: r for r in trie_rows(df)}
    convs = rebuilt(rows)
    assert len(convs[7]) == 3_000
    assert max(d for _, d in found) == 3_000
    root = found[(0, 0)]
    distinct = {tuple(seq[: d + 1]) for seq in convs.values() for d in range(len(seq))}
    assert len(found) == len(distinct) + 1
    chars = sum(len(t) for seq in convs.values() for _, t in seq)
    assert root[6] == chars - sum(len(node[-1][1]) for node in distinct)
    assert found[(7, 3_000)][7] == sha("7")


def test_empty_trie(spark):
    assert trie_rows(spark.createDataFrame([], CONVERSATIONS)) == []


def test_unlike_turns_with_one_hash_are_noticed(spark, monkeypatch):
    """With hashes that clash the trie is made anew; with hashes that always clash it is an error."""
    from pyspark.sql import functions as F

    real = F.xxhash64
    rows = [(1, 0, "user", "a"), (2, 0, "user", "b"), (3, 0, "user", "c")]
    df = spark.createDataFrame(rows, CONVERSATIONS)

    def clashing(*columns):
        if len(columns) == 1:
            return real(*columns)
        return F.when(columns[0] < 2, F.lit(1).cast("bigint")).otherwise(real(*columns))

    monkeypatch.setattr(conversation_trie.F, "xxhash64", clashing)
    assert trie_rows(df) == plain_trie(rows)
    monkeypatch.setattr(
        conversation_trie.F, "xxhash64", lambda *c: real(*c) if len(c) == 1 else F.lit(1).cast("bigint")
    )
    with pytest.raises(RuntimeError):
        trie_rows(df)


# URL models


def split_url(url):
    if url is None or "://" not in url:
        return "", ""
    after = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", after)[0]
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    return lowered, re.match(r"[^?#]*", after[len(host) :])[0]


def rule_of(host, path):
    fits = [
        (len(h + p), len(h), h + p, verdict)
        for verdict, h, p in url_models.RULES
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return max(fits)[2:] if fits else (None, None)


def plain_models(urls):
    """Verdicts and scores of all URLs, by counting contexts in dictionaries."""
    order = url_models.ORDER
    parsed = [split_url(u) for u in urls]
    rules = [rule_of(*p) for p in parsed]
    held = [hashlib.md5("".join(p).encode()).hexdigest()[0] in url_models.HELD_OUT for p in parsed]
    counts = {"allow": defaultdict(Counter), "block": defaultdict(Counter)}

    def steps(address):
        padded = url_models.BEGIN * order + address + url_models.END
        for at in range(order, len(padded)):
            yield padded[at - order : at], padded[at]

    for p, (_, verdict), out in zip(parsed, rules, held, strict=True):
        if verdict and not out:
            for context, c in steps("".join(p)):
                for k in range(order + 1):
                    counts[verdict][context[order - k :]][c] += 1

    def probability(kind, context, c):
        value = url_models.UNSEEN
        for k in range(order + 1):
            seen = counts[kind].get(context[order - k :])
            if seen:
                value = (seen[c] + len(seen) * value) / (sum(seen.values()) + len(seen))
        return value

    def score(p):
        ratios = [
            math.log(probability("allow", ctx, c)) - math.log(probability("block", ctx, c))
            for ctx, c in steps("".join(p))
        ]
        return sum(ratios) / len(ratios)

    scores = [score(p) if verdict is None or out else None for p, (_, verdict), out in zip(parsed, rules, held, strict=True)]
    known = [(s, v) for s, (_, v), out in zip(scores, rules, held, strict=True) if v and out]
    totals = Counter(v for _, v in known)
    least = 0.0
    if len(totals) == 2:

        def error(at):
            return round(
                sum((v == "allow") / totals[v] for s, v in known if math.floor(s * 100) < at)
                + sum((v == "block") / totals[v] for s, v in known if math.floor(s * 100) >= at),
                9,
            )

        least = min((error(at), abs(at), at) for at in range(-1_000, 1_001))[2] / 100
    out = []
    for p, (rule, verdict), s in zip(parsed, rules, scores, strict=True):
        out.append((*p, rule, verdict or ("allow" if math.floor(s * 100) >= round(100 * least) else "block"), None if verdict else s))
    return out


ODD_URLS = [
    None,
    "",
    "no scheme",
    "http://",
    "https://Example.COM/en/1",
    "https://WWW.example.com/en/1?x=/es/",
    "https://www.example.com",
    "http://com/",
    "http://notexample.com/en/",
    "http://a.net/es/1",
    "http://a.net/es",
    "http://a.net?q=/es/",
    "x://y://z/es/",
    "http://ünï.net/fr/ü😀",
    "http://a.org/" + "long/" * 4_000,
]


def check_urls(spark, urls, df=None):
    if df is None:
        rows = [(k, u, "html", "clash", 1) for k, u in enumerate(urls)]
        df = spark.createDataFrame(rows, "page_id long, url string, html string, gram string, label int")
    found = {r["page_id"]: r for r in url_models.judge_urls(df).collect()}
    expected = plain_models(urls)
    assert len(found) == len(urls)
    for k, (host, path, rule, verdict, score) in enumerate(expected):
        assert (found[k]["host"], found[k]["path"], found[k]["rule"]) == (host, path, rule)
        if score is None:
            assert found[k]["score"] is None
        else:
            assert found[k]["score"] == pytest.approx(score, abs=1e-9)
        assert found[k]["verdict"] == verdict


def test_urls_equal_plain_models(spark):
    urls = [r["url"] for r in table(spark, SF_DIR, "pages").orderBy("page_id").select("url").collect()]
    check_urls(spark, urls + ODD_URLS + urls[:5] + [urls[0]] * 40)


def test_urls_without_training_text(spark):
    check_urls(spark, ["http://a.org/1", None, "http://b.org/2"])
    check_urls(spark, ["http://a.com/1", None, "http://b.org/2"])


def test_no_urls(spark):
    assert url_models.judge_urls(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_models_tell_kinds_of_addresses_apart(spark):
    """Addresses like the blocked ones are blocked where no rule fits, the others are not."""
    rng = random.Random(3)

    def word(letters):
        return "".join(rng.choice(letters) for _ in range(12))

    good, bad = "abcdefgh", "qrstuvwxyz"
    urls = [f"http://{word(good)}.com/{word(good)}" for _ in range(150)]
    urls += [f"http://{word(bad)}.net/es/{word(bad)}" for _ in range(150)]
    urls += [f"http://{word(good)}.org/{word(good)}" for _ in range(30)]
    urls += [f"http://{word(bad)}.org/{word(bad)}" for _ in range(30)]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    verdicts = {r["page_id"]: r["verdict"] for r in url_models.judge_urls(df).collect()}
    assert [verdicts[k] for k in range(300, 330)].count("allow") >= 28
    assert [verdicts[k] for k in range(330, 360)].count("block") >= 28


# Periodic runs


def plain_runs(words):
    n, out = len(words), []
    for q in range(1, n // 2 + 1):
        i = q
        while i < n:
            if words[i] != words[i - q]:
                i += 1
                continue
            start = i - q
            while i < n and words[i] == words[i - q]:
                i += 1
            length = i - start
            if length >= max(12, 2 * q) and not any(
                words[start + p : i] == words[start : i - p] for p in range(1, q)
            ):
                out.append((start, length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_digest(doc_id, text):
    words = (text or "").encode("utf-8", "surrogatepass").split()
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        a = (h // 10) % n
        p = 1 + (n - a) // (3 + (h // 10) % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = plain_runs(words)
    drop = {i for s, length, q in found for i in range(s + q, s + length)}
    best = max(found, key=lambda r: (r[1], -r[0], -r[2])) if found else (None, None, None)
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    kept = b" ".join(w for i, w in enumerate(words) if i not in drop)
    milli = 1000 * best[1] // best[2] if found else None
    return (doc_id, len(found), *best, milli, sha(listed), hashlib.sha256(kept).hexdigest())


def digests(df):
    return sorted((tuple(r) for r in periodic_runs.run_digests(df).collect()), key=str)


@settings(max_examples=400, deadline=None)
@given(st.data())
def test_runs_equal_plain_python(data):
    words = data.draw(st.lists(st.integers(0, data.draw(st.integers(0, 4))), max_size=60))
    for _ in range(data.draw(st.integers(0, 3))):
        if words:
            begin = data.draw(st.integers(0, len(words) - 1))
            lag = data.draw(st.integers(1, 20))
            for i in range(max(begin, lag), data.draw(st.integers(begin, len(words)))):
                words[i] = words[i - lag]
    found = periodic_runs.find_runs(np.array(words, np.int64))
    assert found == plain_runs(words)
    if found:
        assert periodic_runs._may_repeat([np.array(words, np.int64)])[0]


def test_run_digests_equal_plain_python(docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    short = [(i, t) for i, t in rows if len(t.split()) < 400]
    keep = {i for i, _ in short}
    assert digests(docs.where(docs.doc_id.isin(list(keep)))) == sorted((plain_digest(*r) for r in short), key=str)


def test_runs_on_odd_rows(odd, empty):
    expected = [plain_digest(r["doc_id"], r["text"]) for r in odd.collect() if len(r["text"] or "") < 5_000]
    found = digests(odd)
    assert len(found) == odd.count()
    assert set(expected) <= set(found)
    assert digests(empty) == []


def test_runs_of_long_texts_are_found_in_seconds():
    """200,000 words in periods short and long, in runs of runs, and without any."""
    rng = np.random.default_rng(1)
    cases = [
        (np.zeros(200_000, np.int64), [(0, 200_000, 1)]),
        (np.tile(np.arange(7), 30_000), [(0, 210_000, 7)]),
        (np.tile(rng.integers(0, 1_000, 20_000), 10), [(0, 200_000, 20_000)]),
        (np.arange(200_000), []),
    ]
    for ids, expected in cases:
        assert periodic_runs.find_runs(ids) == expected
    assert len(periodic_runs.find_runs(np.tile(np.append(np.zeros(50, np.int64), 1), 4_000))) == 4_001


def test_collapse_keeps_columns_and_other_texts(spark):
    rows = [(1, "x " * 30 + "end", "s"), (2, "no  run\there", "s"), (3, None, None), (4, "", "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, words string")
    out = {r["doc_id"]: (r["text"], r["words"]) for r in periodic_runs.collapse_repeats(df).collect()}
    assert out == {1: ("x end", "s"), 2: ("no  run\there", "s"), 3: (None, None), 4: ("", "s")}
    listed = periodic_runs.periodic_runs(df).collect()
    assert [tuple(r) for r in listed] == [(1, 0, 30, 1, "x")]


# Registered queries beside their SQL


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, name):
    assert differences(QUERIES[name](spark, SF_DIR), ORACLES[name], duck(SF_DIR)) is None
