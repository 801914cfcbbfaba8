import itertools
import math
import random
import re

from pyspark.sql import functions as F
import pytest

from agrospark.llm import decontaminate as D, line_templates as T, quality as Q
from tests.llm import brute
from tests.llm.texts import BASE, COMMON, PASSAGE, ROWS, prose

BENCH = "item_id bigint, text string, doc_id bigint"


# --- quality ------------------------------------------------------------------------------------

def test_base_rules_equal_a_plain_count(spark, documents):
    rows = ROWS + [(30, "a b c d e " * 3 + "f g"), (31, "w " * 9), (32, "a\n\n a \n#$a\n a "), (33, None)]
    for r in Q.judged(documents(rows)).select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                                              "n_repeat_words", "base_failed").collect():
        assert tuple(r)[1:] == brute.quality(dict(rows)[r[0]]), r[0]


def shares(rows, lang):
    total = [0] * (len(Q.CLASSES) + 1)
    for text, language in rows:
        if language == lang:
            for i, n in enumerate(classes(text)):
                total[i] += n
    return [n / sum(total) for n in total]


def classes(text):
    found = [len("".join(re.findall(p, text))) for p in Q.CLASSES.values()]
    return [*found, len(text) - sum(found)]


def test_distances_equal_a_plain_computation(spark, documents):
    texts = [(prose(i, 120), "en") for i in range(4)] + [("1234 5678 ## " * 30, "en"), (prose(9, 60).upper(), None), ("", "en")]
    rows = [(i, t, lang) for i, (t, lang) in enumerate(texts)]
    got = {r.doc_id: r for r in Q.judged(documents(rows)).select("row.doc_id", "js_classes", "js_common", "kept").collect()}
    for i, text, lang in rows:
        if not text:
            assert got[i].js_classes is None and not got[i].kept
            continue
        p, q = [n / len(text) for n in classes(text)], shares(texts, lang)
        half = lambda a, b: sum(x * math.log2(2 * x / (x + y)) for x, y in zip(a, b) if x)
        assert got[i].js_classes == pytest.approx(math.sqrt((half(p, q) + half(q, p)) / 2), abs=1e-9)
    assert got[5].js_common is None and all(got[i].kept for i in range(4))


def test_filter_keeps_rows_as_they_are(spark, documents):
    docs = documents([(1, BASE), (1, BASE), (None, BASE), (2, "short"), (3, None)])
    left = Q.quality_filter(docs)
    assert left.columns == docs.columns and [r.doc_id for r in left.collect()].count(1) == 2 and left.count() == 3
    assert Q.quality_filter(documents([])).count() == 0


def test_long_texts_without_common_words_go(spark, documents):
    strange = " ".join(w for w in prose(50, 400).split() if w not in COMMON)
    fewer = lambda t: " ".join(w for k, w in enumerate(t.split()) if w not in COMMON or k % 3 == 0)  # noqa: E731  a fifth
    rows = [(i, fewer(prose(60 + i, 400))) for i in range(20)] + [(20, strange), (21, " ".join(strange.split()[:60]))]
    rows += [(30 + i, prose(90 + i, 150), "de") for i in range(3)]  # none has a common word: nothing to tell them by
    kept = {r.doc_id for r in Q.quality_filter(documents(rows)).collect()}
    assert kept == {*range(20), 21, 30, 31, 32}


# --- lines --------------------------------------------------------------------------------------

def test_templates_with_variable_fields_go_but_for_the_first_document(spark, documents):
    rows = [(i, f"{prose(100 + i, 40)}\nuser name{i} logged in from host at {i}:22\nok") for i in range(8)]
    rows += [(20 + i, f"{prose(200 + i, 40)}\nAll rights reserved by the authors") for i in range(3)]
    got = {r.doc_id: r for r in T.drop_recurring_lines(documents(rows)).collect()}
    assert got[0].text == rows[0][1] and got[0].n_dropped == 0
    for i in range(1, 8):
        assert got[i].text == f"{prose(100 + i, 40)}\nok" and got[i].n_dropped == 1 and got[i].n_chars == len(got[i].text)
    for i, text in rows[8:]:
        assert got[i].text == text  # three documents are too few


def test_words_vary_too_and_numbers_are_no_template(spark, documents):
    names = prose(700, 20).split()
    rows = [(i, f"{prose(710 + i, 30)}\nYou have mail from {names[i]} today friend\n| {i} | 2 | 3 |") for i in range(9)]
    got = {r.doc_id: r for r in T.drop_recurring_lines(documents(rows)).collect()}
    assert [got[i].n_dropped for i in range(9)] == [0] + [1] * 8
    assert all(got[i].text.endswith(f"| {i} | 2 | 3 |") and "mail" not in got[i].text for i in range(1, 9))


def test_small_templates_are_found_beside_others_of_their_leaf(spark, documents):
    names = prose(800, 90).split()
    kinds = ["We saw that {} left town by the evening train", "We saw that {} won first prize at our fair",
             "We saw that {} lost every game of last week"]
    rows = [(i, f"{prose(810 + i, 20)}\n{kinds[i % 3].format(names[i])}") for i in range(45)]
    rows += [(100 + i, f"{prose(900 + i, 20)}\nDo not ever print this page for more than one reader") for i in range(60)]
    rows += [(200 + i, f"{prose(1000 + i, 20)}\nDo not ever call {names[i]} again if you like quiet nights") for i in range(7)]
    got = {r.doc_id: r.n_dropped for r in T.drop_recurring_lines(documents(rows)).collect()}
    assert {d for d, n in got.items() if not n} == {0, 1, 2, 100, 200} and set(got.values()) == {0, 1}


def test_lines_of_many_fields_go_and_rows_of_numbers_only_if_equal(spark, documents):
    lines = lambda i: [f"2024-01-{i} 12:00:0{i} INFO worker-{i} finished job {i}42", f"Copyright 199{i} 2024 Foo 2.{i}",
                       "| 7 | 8 | 9 |", "--- --- ---", f"| {i} | 2 | 3 |"]
    rows = [(i, "\n".join([prose(1100 + i, 24), *lines(i)])) for i in range(6)]
    got = {r.doc_id: r for r in T.drop_recurring_lines(documents(rows)).collect()}
    assert got[0].text == rows[0][1]
    for i in range(1, 6):
        assert got[i].text == f"{prose(1100 + i, 24)}\n| {i} | 2 | 3 |" and got[i].n_dropped == 4


def test_long_lines_go_from_the_second_document_on(spark, documents):
    passage, year = prose(1200, 40, line=40), "in 1999 " + prose(1201, 30, line=30)
    rows = [(i, f"{prose(1210 + i, 24)}\n{passage}\n{year}\n{year.replace('1999', str(i))}") for i in range(2)]
    got = {r.doc_id: r for r in T.drop_recurring_lines(documents(rows)).collect()}
    assert got[0].text == rows[0][1]
    assert got[1].text == f"{prose(1211, 24)}\n{year.replace('1999', '1')}" and got[1].n_dropped == 2


def test_copies_count_once_and_are_treated_alike(spark, documents):
    line = "the very same footer line"
    rows = [(i, f"{BASE}\n{line}") for i in range(10)] + [(20 + i, f"{prose(300 + i, 30)}\n{line}") for i in range(3)]
    assert all(r.n_dropped == 0 for r in T.drop_recurring_lines(documents(rows)).collect())
    rows += [(30, f"{prose(400, 30)}\n{line}")]
    got = {r.doc_id: r.n_dropped for r in T.drop_recurring_lines(documents(rows)).collect()}
    assert got == {i: 0 for i in range(10)} | {20: 1, 21: 1, 22: 1, 30: 1}


def test_lines_that_only_share_their_beginning_stay(spark, documents):
    rows = [(i, f"In the {prose(500 + i, 8)}") for i in range(40)]
    assert all(r.n_dropped == 0 for r in T.drop_recurring_lines(documents(rows)).collect())


def test_odd_rows_stay(spark, documents):
    docs = documents([(1, None), (2, ""), (None, "a b c d"), (None, "a b c d"), (3, "x\n" * 5000), (4, "é" * 100_000)])
    left = T.drop_recurring_lines(docs)
    assert left.columns == [*docs.columns, "n_dropped"]
    assert sorted((r.doc_id or 0, r.text or "") for r in left.collect()) == sorted(
        (r.doc_id or 0, r.text or "") for r in docs.collect())
    assert T.drop_recurring_lines(documents([])).count() == 0


def random_lines(seed):
    """Documents of templates with fields and varying words, prose that begins alike, tables, passages and copies."""
    r = random.Random(seed)
    words = prose(2000 + seed, 60).split()
    some = lambda n: " ".join(r.choices(words, k=n))
    frames = [some(r.randint(5, 8)).split() for _ in range(6)]
    passages = [some(r.randint(18, 24)) for _ in range(4)]
    rows = []
    for doc in range(150):
        lines = [some(r.randint(1, 12)) for _ in range(3)]
        for frame in r.sample(frames, 2):
            line = list(frame)
            for place in r.sample(range(len(line)), r.randint(0, 2)):
                line[place] = r.choice([str(r.randint(0, 99)), r.choice(words), f"id{doc}"])
            lines.append(r.choice([" ", "  ", "\t"]).join(line))
        lines.append(" ".join(frames[0][:3]) + " " + some(len(frames[0]) - 3))
        lines.append(f"| {r.randint(0, 5)} | {r.randint(0, 1)} |")
        if r.random() < 0.2:
            lines.append(r.choice(passages))
        r.shuffle(lines)
        rows.append((doc, "\n".join(lines)))
    return rows + [(200 + i, rows[r.randrange(20)][1]) for i in range(8)] + [(300, "")]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_dropped_lines_equal_a_plain_search_for_templates(spark, documents, seed):
    rows = random_lines(seed)
    gone = brute.line_templates(rows)
    assert sum(map(len, gone.values())) > 150
    for r in T.drop_recurring_lines(documents(rows)).collect():
        text = dict(rows)[r.doc_id]
        left = [x for i, x in enumerate(text.split("\n")) if i not in gone[text]]
        assert (r.text, r.n_dropped) == ("\n".join(left), len(gone[text])), r.doc_id


# --- benchmark ----------------------------------------------------------------------------------

def hashes(text):
    return [w for w in re.split(r"[^0-9a-zà-ÿ]+", text.lower()) if w]


def plain_overlaps(rows, items, window=16, percent=80, least=11):
    """Documents and items with a stretch of enough equal tokens; every alignment is tried."""
    found = set()
    for d, text in rows:
        w = hashes(text or "")
        for k, item in items:
            v = hashes(item or "")
            size = min(window, len(v))
            if len(v) < 5:
                continue
            if len(v) < least:
                if any(w[i:i + len(v)] == v for i in range(len(w))):
                    found.add((d, k))
                continue
            for shift in range(-len(v), len(w)):
                same = [0 <= shift + i < len(w) and w[shift + i] == v[i] for i in range(len(v))]
                inside = [s for i, s in enumerate(same) if 0 <= shift + i < len(w)]
                if any(100 * sum(inside[s:s + size]) >= percent * size for s in range(len(inside) - size + 1)):
                    found.add((d, k))
    return found


def substituted(text, places):
    words = text.split(" ")
    return " ".join(f"other{i}" if i in places else w for i, w in enumerate(words))


def test_passages_with_substitutions_are_found(spark, documents):
    item = " ".join(prose(600, 40).split())
    rows = [(1, prose(1, 80) + " " + item), (2, substituted(item, {3, 9, 17, 26, 33})), (3, prose(602, 50) + " " + " ".join(item.split()[10:28])),
            (4, prose(3, 200)), (5, None), (6, ""), (7, item.upper().replace(" ", ", ")), (8, " ".join(item.split()[:8])),
            (9, substituted(item, set(range(0, 40, 2)))), (None, item), (1, "other text of the same id")]
    items = [(10, item), (11, "too short"), (12, None), (13, PASSAGE), (10, item)]
    bench = spark.createDataFrame([(*i, 0) for i in items], BENCH)
    got = D.overlaps(documents(rows), bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == plain_overlaps(rows, items) == {(1, 10), (2, 10), (3, 10), (7, 10), (None, 10)}
    exact = next(r for r in got if r.doc_id == 1)
    assert (exact.first_token, exact.n_tokens, exact.n_equal) == (80, 16, 16)
    left = D.drop_contaminated(documents(rows), bench)
    assert sorted((r.doc_id, r.text or "")[0] for r in left.collect()) == [1, 4, 5, 6, 8, 9]


def test_without_broadcast_and_with_empty_tables(spark, documents, monkeypatch):
    monkeypatch.setattr(D, "BROADCAST_SEEDS", 0)
    bench = spark.createDataFrame([(1, PASSAGE, 0)], BENCH)
    assert {r.doc_id for r in D.overlaps(documents(ROWS), bench).collect()} == {9, 10, 16, 18}
    assert D.overlaps(documents([]), bench).count() == 0
    assert D.overlaps(documents(ROWS), bench.limit(0)).count() == 0


def test_some_mask_takes_equal_tokens_only_whatever_is_substituted():
    span = len(D.MASKS[0])
    for n, changed in ((11, 2), (12, 2), (13, 2), (14, 2), (15, 3), (16, 3)):
        assert 100 * (n - changed) >= 80 * n > 100 * (n - changed - 1)
        for bad in itertools.combinations(range(n), changed):
            assert any(all(m[i] == "0" or s + i not in bad for i in range(span))
                       for s in range(n - span + 1) for m in D.MASKS), (n, bad)


def test_every_accepted_substitution_of_short_stretches_is_found(spark, documents):
    words = [f"w{i}" for i in range(16)]
    patterns = [(n, bad) for n, changed in ((11, 2), (12, 2), (15, 3)) for bad in itertools.combinations(range(n), changed)]
    rows = [(n * 1000 + k, substituted(" ".join(words[:n]), set(bad))) for k, (n, bad) in enumerate(patterns)]
    for n in (11, 12, 15):
        bench = spark.createDataFrame([(n, " ".join(words[:n]), 0)], BENCH)
        got = D.overlaps(documents([r for r in rows if r[0] // 1000 == n]), bench)
        assert {r.doc_id for r in got.collect()} == {r[0] for r in rows if r[0] // 1000 == n}


def test_short_items_count_word_for_word(spark, documents):
    items = [(1, "alpha beta gamma delta epsilon"), (2, "one two three four five six seven eight nine ten"),
             (3, "only four words here"), (4, "Alpha, beta: gamma delta zeta?")]
    rows = [(1, "so alpha BETA gamma, delta epsilon it is"), (2, "alpha beta gamma delta other"), (3, "only four words here"),
            (4, "one two three four five six seven eight nine"), (5, "x " + items[1][1]), (6, items[0][1]), (7, "alpha beta gamma delta"),
            (8, items[3][1] + " " + items[0][1]), (9, None), (None, items[0][1])]
    got = D.overlaps(documents(rows), spark.createDataFrame([(*i, 0) for i in items], BENCH)).collect()
    assert {(r.doc_id, r.item_id) for r in got} == plain_overlaps(rows, items) == {
        (1, 1), (5, 2), (6, 1), (8, 1), (8, 4), (None, 1)}
    assert all(r.n_equal == r.n_tokens for r in got)


def test_columns_of_any_name_come_through(spark, documents):
    docs = documents([(1, PASSAGE), (2, prose(700, 30))])
    for name in ("_d", "_h", "h", "d", "f", "row", "tokens", "seed", "place"):
        docs = docs.withColumn(name, F.lit(1))
    left = D.drop_contaminated(docs, spark.createDataFrame([(1, PASSAGE, 0)], BENCH))
    assert left.columns == docs.columns and [r.doc_id for r in left.collect()] == [2]
