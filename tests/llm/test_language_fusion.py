"""The fused language of pages beside the same sums in plain Python."""

import math
import random
import re
from collections import Counter, defaultdict

import pytest

from parcelpulse.llm import language_fusion as fusion

TEXTS = [
    ("der hund und die katze laufen durch den wald", "de"),
    ("the dog and the cat run through the wood", "en"),
    ("le chien et le chat courent dans la forêt", "fr"),
    ("und noch ein satz über häuser", "de"),
    ("another line about houses", "en"),
    (None, "fr"),
    ("no language here", None),
]


def grams(text):
    plain = " " + re.sub(r"[^\w]+|[\d_]+", " ", text.lower()).strip() + " "
    return Counter(plain[k : k + 3] for k in range(len(plain) - 2))


def plain_fusion(pages, texts):
    counts = defaultdict(Counter)
    for text, lang in texts:
        if lang is not None:
            counts[lang].update(grams(text or ""))
    langs = sorted(lang for lang in counts if counts[lang])
    totals = {lang: sum(counts[lang].values()) + fusion.FEATURES for lang in langs}
    known = set().union(*(counts[lang] for lang in langs))

    def soft(logs):
        top = max(logs)
        odds = [math.exp(x - top) for x in logs]
        return [x / sum(odds) for x in odds]

    rows = []
    for page_id, url, html in pages:
        found = re.match(r"[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", url or "")
        host = found[1].lower() if found else ""
        tag = re.search(r"(?i)<html\b[^<>]*?\blang\s*=\s*[\"']?([A-Za-z]+)", html or "")
        here = grams(fusion.visible(html or ""))
        logs = [
            sum(n * math.log((counts[lang][g] + 1) / totals[lang]) for g, n in here.items() if g in known) / fusion.TEMPER
            for lang in langs
        ]
        rows.append((page_id, host, host.rsplit(".", 1)[-1], tag[1].lower() if tag else "", logs, soft(logs)))
    n = len(langs)

    def sums(key):
        out = defaultdict(lambda: [0.0] * n)
        for row in rows:
            out[key(row)] = [a + b for a, b in zip(out[key(row)], row[5], strict=True)]
        return out

    def smoothed(own, wider):
        return [(x + fusion.SMOOTH * p) / (sum(own) + fusion.SMOOTH) for x, p in zip(own, wider, strict=True)]

    everywhere = smoothed(sums(lambda r: 0)[0], [1 / n] * n)
    suffixes = {k: smoothed(v, everywhere) for k, v in sums(lambda r: r[2]).items()}
    hosts = sums(lambda r: r[1])
    tags = sums(lambda r: r[3])
    lang_sum = [sum(v[k] for v in tags.values()) for k in range(n)]
    out = []
    for page_id, host, suffix, tag, logs, post in rows:
        prior = smoothed(hosts[host], suffixes[suffix])
        given = [(x + 1) / (s + len(tags)) for x, s in zip(tags[tag], lang_sum, strict=True)]
        final = soft([a + math.log(b) + math.log(c) for a, b, c in zip(logs, prior, given, strict=True)])
        out.append((page_id, langs[final.index(max(final))], max(final), tag, host, langs[post.index(max(post))]))
    return out


def test_fusion_equals_plain_python(spark):
    rng = random.Random(8)
    words = " ".join(t for t, _ in TEXTS if t).split()
    pages = [(None, None, None), (1, "", ""), (2, "http://ÄÖ.de/x", "<html lang=de>" + "und " * 5_000)]
    for k in range(3, 40):
        body = " ".join(rng.choice(words) for _ in range(rng.randint(0, 12)))
        tag = rng.choice(["", " lang='fr'", ' lang="DE-at"', " xml:lang=en", " lang=1"])
        host = rng.choice(["a.fr", "b.a.fr", "c.de", "user@d.com:80", ""])
        pages.append((k, f"http://{host}/{k}", f"<HTML{tag}><!-- the the --><p>{body}</p><script>and</script>"))
    pages.append(pages[5])
    made = spark.createDataFrame([(*p, "x", 1.0) for p in pages], "page_id long, url string, html string, host string, prior double")
    texts = spark.createDataFrame([(k, t, lang, 0) for k, (t, lang) in enumerate(TEXTS)], "doc_id long, text string, lang string, n int")
    found = [tuple(r) for r in fusion.page_languages(made, texts).collect()]
    wanted = plain_fusion(pages, TEXTS)
    order = lambda r: (r[0] is None, r[0] or 0, r[3])
    assert len(found) == len(wanted)
    for a, b in zip(sorted(found, key=order), sorted(wanted, key=order), strict=True):
        assert a[:2] + a[3:] == b[:2] + b[3:]
        assert a[2] == pytest.approx(b[2], rel=1e-9)


def test_languages_of_the_model_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(fusion, "LANGUAGES", 2)
    rows = [(k, f"word{k % 7} " * (1 + k % 5), f"l{k % 5}") for k in range(50)]
    texts = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    langs, model, _ = fusion.train(texts)
    assert len(langs) == 2 and all(len(w) == 2 for w in model.values())
