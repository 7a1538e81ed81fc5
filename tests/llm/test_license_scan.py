import re

import pytest
from cases import awkward, bag, documents, empty, plain

from codequarry.llm import license_scan

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def expected(rows, phrases=license_scan.PHRASES, notices=license_scan.NOTICES, gap=2, share=0.75):
    out = []
    for i, text in rows:
        words = WORD.findall(text.translate(LOWER))
        places, base, labels, score = [], set(), set(), 0.0
        for label, phrase in phrases:
            p = phrase.split()
            at = [k for k in range(len(words)) if words[k : k + len(p)] == p]
            places += at
            if at:
                base.add(label)
                score = 1.0
        for label, notice in notices:
            p = notice.split()
            grams = len(p) - 1
            votes = {}
            for k in range(len(words) - 1):
                for t in range(grams):
                    if words[k] == p[t] and words[k + 1] == p[t + 1]:
                        votes.setdefault(k - t, set()).add(t)
            spans = []
            for d in sorted(votes):
                if spans and d - spans[-1][0] <= gap:
                    spans[-1] = (d, spans[-1][1] | votes[d])
                else:
                    spans.append((d, votes[d]))
            best = max((len(v) / grams for _, v in spans), default=0.0)
            score = max(score, best)
            if best >= share:
                labels.add(label)
        first, last = (min(places), max(places)) if places else (None, None)
        out.append((i, len(words), len(places), first, last, ",".join(sorted(base)), ",".join(sorted(base | labels)), round(score, 9)))
    return out


def found(docs):
    rows = license_scan.scan(docs).collect()
    return [(*(r[:7]), round(r["score"], 9)) for r in rows]


@pytest.mark.parametrize("source", [awkward, documents])
def test_scan(spark, source):
    docs = source(spark)
    assert bag(found(docs)) == bag(expected(plain(docs)))


def test_changed_notices_and_phrases(spark):
    mit = dict((label, text) for label, text in license_scan.NOTICES)["mit"]
    words = mit.split()
    texts = [
        "MIT license, mit-License; MIT\nLICENSE mit licenses",
        "General Public License general public public license",
        mit.upper() + " and more",
        " ".join(words[:9] + ["truly", "anyone"] + words[9:]),
        " ".join(words[:6]),
        " ".join(w for k, w in enumerate(words) if k != 10),
        "Apache License License apache apache LICENSE version 2.0",
        "MITİ License, Kit license",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = found(docs)
    assert bag(got) == bag(expected(plain(docs)))
    labels = {r[0]: r[6] for r in got}
    assert labels[2] == labels[3] == labels[5] == "mit" and labels[4] == ""


def test_empty(spark):
    assert license_scan.scan(empty(spark)).collect() == []


def test_native(spark):
    plan = license_scan.scan(documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
