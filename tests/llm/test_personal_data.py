import random

from pyspark.sql import functions as F

from agrospark.llm import pii as P
from tests.llm import brute
from tests.llm.texts import ROWS

TRICKY = [
    "a@b.c_x@d.com a@b.co.uk. x@y z@.com %+-@a-b.c-d", "1.2.3.4.5.6.7.8 256.1.1.1 0255.01.001.0 1.2.3.4444 999999999999.1.1.1",
    "4111 1111 1111 1111 4111-1111-1111-1112 4111  1111 4111111111111111 1 2 3 4 5 6 7 8 9 0 1 2 3",
    "+1 (521) 555-6210 +1234 +12345678901234567 +1 2 3 4 5 6 7 8 9. ++49 30 1234567-", "é\U0001f600 a@b.cd 1.1.1.1 +49 170 1234567",
    "4222222222222 4222222222222222222 42222222222222222222", "a" * 50_000 + "@b.cc" + "1" * 50_000, "+" * 2000 + "(" * 2000,
]


def test_base_spans_equal_plain_patterns(spark, documents):
    rows = ROWS + [(100 + i, t) for i, t in enumerate(TRICKY)]
    got = P.find_personal_data(documents(rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert tuple(r)[1:6] == brute.pii(dict(rows)[r.doc_id]), r.doc_id
        listed = r.spans.split(",") if r.spans else []
        assert {f"{k}:{a}:{b}" for a, _, b, k in brute.base_spans(dict(rows)[r.doc_id])} <= set(listed)
        places = [(int(s.split(":")[1]), P.KINDS.index(s.split(":")[0]), int(s.split(":")[2])) for s in listed]
        assert places == sorted(places)


def test_similar_candidates_are_added_and_others_are_not(spark, documents):
    rng = random.Random(5)
    number = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    rows = []
    for i in range(400):
        rows.append((2 * i, f"please call or write to us at phone +1 ({number(3)}) 555-{number(4)} in the morning {i}"))
        rows.append((2 * i + 1, f"the sum in the table of all parts is {rng.randint(10**13, 10**14 - 1)}7 in line {i}"))
    rows.append((9001, "please call or write to us at phone (312) 555-0143 in the morning"))
    rows.append((9002, "nothing of the kind"))
    got = {r.doc_id: r.spans for r in P.find_personal_data(documents(rows)).collect()}
    assert got[9001].startswith("phone:") and got[9002] == ""
    sums = [got[2 * i + 1] for i in range(400)]
    assert sum(bool(s) for s in sums) < 60  # the tenth that pass the Luhn sum are base spans


def test_empty_and_repeated(spark, documents):
    assert P.find_personal_data(documents([])).count() == 0
    got = P.find_personal_data(documents([(1, "a@b.cc"), (1, "a@b.cc"), (None, "a@b.cc"), (None, None)])).collect()
    assert sorted((r.doc_id or 0, r.n_email, r.spans) for r in got) == [
        (0, 0, ""), (0, 1, "email:0:6"), (1, 1, "email:0:6"), (1, 1, "email:0:6")]


def test_secrets_behind_assignments_are_added(spark, documents):
    rng = random.Random(9)
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    hexes = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    rows, secrets, clean = [], {}, []
    for i in range(60):
        text = f'some words before token = "{hexes(40)}" and some behind {i}'
        rows += [(10 * i, text), (10 * i + 1, f"write to a{i}@b.org or call +49 170 {digits(7)} now"),
                 (10 * i + 2, f"the sum of all parts is {digits(16)} in line {i}"), (10 * i + 3, f"commit {hexes(40)} moved line {i}"),
                 (10 * i + 4, f"nothing of the kind in {i}")]
        secrets[10 * i] = f"secret:{text.index(chr(34)) + 1}:{text.index(chr(34)) + 41}"
        clean += [10 * i + 3, 10 * i + 4]
    got = {r.doc_id: r.spans for r in P.find_personal_data(documents(rows)).collect()}
    assert sum(got[d] == s for d, s in secrets.items()) > 0.9 * len(secrets)
    assert sum(got[d] == "" for d in clean) > 0.95 * len(clean)


def test_luhn_sums(spark):
    rng = random.Random(3)
    numbers = ["".join(rng.choice("0123456789") for _ in range(n)) for n in range(22) for _ in range(20)] + ["4111111111111111", "1" * 30_000]
    df = spark.createDataFrame([(n,) for n in numbers], "d string").select("d", P._luhn(F.col("d")).alias("ok"))
    for r in df.collect():
        assert r.ok == (12 <= len(r.d) <= 19 and brute.luhn(r.d)), r.d


def test_every_candidate_is_learned_from(spark, documents, monkeypatch):
    seen = []
    fit = P.GBTClassifier.fit
    monkeypatch.setattr(P.GBTClassifier, "fit", lambda self, df, *a: seen.append(df.count()) or fit(self, df, *a))
    rows = [(i, " ".join(f"x{i}y{j}@b.org 0{j % 10}12 {i % 900 + 100} 5{j:03d}" for j in range(110))) for i in range(100)]
    found = P.store(P.beside_base(P.features(P.candidates(documents(rows)))), "all-candidates")
    P.added(found, rounds=1, depth=1)
    assert sum(seen) == found.count() > 20_000
