"""Texts for the tests."""

import random

COMMON = "the of and to in is that for it as with was on are by be at from this or".split()


def prose(seed, n, line=12):
    rng = random.Random(seed)
    made = ["".join(rng.choice("abcdefghilmnoprstu") for _ in range(rng.randint(2, 9))) for _ in range(400)]
    words = [rng.choice(COMMON) if rng.random() < 0.45 else rng.choice(made) for _ in range(n)]
    return "\n".join(" ".join(words[i:i + line]) for i in range(0, n, line))


def changed(text, seed, n):
    """The text with n words replaced."""
    rng, words = random.Random(seed), text.split(" ")
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


BASE = prose(1, 300)
PASSAGE = prose(2, 90).replace("\n", " ")

# Null, empty and blank texts, one word, exact and near copies, shared passages, long texts, other scripts.
ROWS = [
    (1, None), (2, ""), (3, " \n\t \x0b"), (4, "one"), (5, BASE), (6, BASE), (7, changed(BASE, 3, 4)),
    (8, changed(BASE, 4, 6)), (9, prose(5, 200) + " " + PASSAGE + " " + prose(6, 50)),
    (10, PASSAGE + "\n" + prose(7, 150)), (11, prose(8, 40_000)), (12, "a" * 3000), (13, "ab" * 900 + "é" + "ab" * 900),
    (14, "ΑΣ ÀÉÎ ǅ İ ﬀ e\u0301 x\u00a0y\x85z 你好 \U0001f600\U0001f600 's 'LL <|endoftext|>don't</w>"),
    (15, "same line here now\n" * 30), (16, "x " * 12 + PASSAGE[:420]), (17, BASE.upper()), (18, PASSAGE[:399] + "Q"),
    (19, "\\ </s> [INST]"), (20, "# * $ % & | < >"), (-3, prose(9, 60)), (10**12, prose(9, 60) + " end"),
]
