"""Plain versions of the operators, for tests."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text):
    return WORD.findall(text or "")


def sha(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def bpe(tokenizer, rows):
    out = {}
    for doc_id, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        out[doc_id] = (len(ids), sha(" ".join(map(str, ids))), sha(tokenizer.decode(ids, skip_special_tokens=False)))
    return out


def token_file(tokenizer, rows):
    out, start = {}, 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        out[doc_id] = (start, len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids)))
        start += len(ids)
    return out


def quality(text):
    text = text or ""
    w = words(text)
    grams = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    covered = set()
    for i in range(len(w) - 4):
        if grams[tuple(w[i:i + 5])] > 1:
            covered.update(range(i, i + 5))
    lines = [x for x in text.split("\n") if words(x)]
    failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed)


def chat(rows):
    by = defaultdict(list)
    for conv_id, turn, role, text in rows:
        by[conv_id].append((turn, role or "", text or ""))
    out = {}
    for conv_id, turns in by.items():
        turns.sort(key=lambda t: (t[0] is not None, t))
        said = "".join(t for _, r, t in turns if r == "assistant")
        out[conv_id] = (len(turns), sha("".join(f"{r}\n{t}\n" for _, r, t in turns)), len(said), sha(said))
    return out


def repeats(rows, size=400):
    """doc_id: (bytes, removed, spans, digest of what is left)."""
    data = [(d, (t or "").encode()) for d, t in rows]
    seen = Counter(t[i:i + size] for _, t in data for i in range(len(t) - size + 1))
    out = {}
    for d, t in data:
        gone = bytearray(len(t))
        for i in range(len(t) - size + 1):
            if seen[t[i:i + size]] > 1:
                gone[i:i + size] = b"\1" * size
        out[d] = (len(t), sum(gone), len(re.findall(b"\1+", bytes(gone))), sha(bytes(b for b, g in zip(t, gone) if not g)))
    return out


def near(rows, share=85, size=3):
    """doc_id: (shingles, component, kept); every pair is compared."""
    sets = {}
    for d, t in rows:
        w = lower(t)
        w = words(w)
        sets[d] = {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= share * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d), find(d) == d) for d in ids}


_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text):
    """(start, rank, end, kind), in order."""
    text = text or ""
    only = lambda s: re.sub("[^0-9]", "", s)
    checks = {
        "email": (_EMAIL, lambda s: True), "ip": (_IP, lambda s: all(int(p) <= 255 for p in s.split("."))),
        "card": (_CARD, lambda s: 12 <= len(only(s)) <= 19 and luhn(only(s))),
        "phone": (_PHONE, lambda s: 9 <= len(only(s)) <= 15),
    }
    return sorted((m.start(), k, m.end(), name) for k, (name, (p, ok)) in enumerate(checks.items())
                  for m in p.finditer(text) if ok(m[0]))


def pii(text):
    spans = base_spans(text)
    counts = Counter(s[3] for s in spans)
    return (*(counts[k] for k in ("email", "ip", "card", "phone")), sha(",".join(f"{n}:{a}:{b}" for a, _, b, n in spans)))


def line_templates(rows, min_docs=5, depth=3, min_tokens=3, min_fixed=0.6, agreed=0.5, long=20):
    """{text: numbers of the lines that go}, by loops over all lines; rows are (doc_id, text) with ids of their own."""
    first_of, lines = {}, []
    for doc, text in rows:
        first_of[text] = min(doc, first_of.get(text, doc))
    for text in first_of:
        for at, line in enumerate(text.split("\n")):
            said = WORD.findall(line)
            tokens = tuple("<*>" if re.search("[0-9]", t) else t for t in said)
            if len(tokens) >= min_tokens:
                lines.append((text, at, tokens, " ".join(said) if "<*>" in tokens else None))
    order = lambda texts: min(texts, key=first_of.get)
    texts_of = defaultdict(set)
    for text, _, tokens, _ in lines:
        texts_of[tokens].add(text)
    leaves = defaultdict(list)
    for tokens in texts_of:
        leaves[len(tokens), tokens[:depth]].append(tokens)
    held_by, choices = defaultdict(list), defaultdict(list)
    for leaf, members in leaves.items():
        count = {t: len(texts_of[t]) for t in members}
        if sum(count.values()) < min_docs:
            continue
        loose = {t: n if n < min_docs else 0 for t, n in count.items()}
        whole = sum(loose.values())
        half = max(agreed * whole, min_docs)
        for line in members:
            words = []
            for place, token in enumerate(line):
                if any(c.isalpha() for c in token):
                    seen = sum(loose[t] for t in members if t[place] == token)
                    words.append((place, token, seen if seen >= min_docs else 0))
            limits = {2 ** math.floor(math.log2(w[2])) for w in words if w[2]} | {half}
            if count[line] >= min_docs:
                limits.add(0)
            for held in {tuple(w for w in words if w[2] >= limit) for limit in limits}:
                full = count[line] >= min_docs and len(held) == len(words)
                if (held and len(held) >= min_fixed * len(words)) or (not held and full and "<*>" not in line):
                    name = leaf, tuple(w[:2] for w in held) or line
                    chance = None if held and not whole else whole * math.prod(w[2] / whole for w in held)
                    held_by[name].append((line, count[line], loose[line], full or all(w[2] >= half for w in held), chance))
    for name, found in held_by.items():
        docs, others = sum(f[1] for f in found), sum(f[2] for f in found)
        chance = max((f[4] for f in found if f[4] is not None), default=math.inf)
        together = others * agreed >= chance and others >= chance + 2 * math.sqrt(chance) if chance < math.inf else False
        if docs >= min_docs and (any(f[3] for f in found) or together):
            for f in found:
                choices[f[0]].append((docs, name))
    taken = defaultdict(list)
    for line, names in choices.items():
        taken[max(names, key=lambda x: x[0])[1]].append(line)
    kept_in = {}
    for members in taken.values():
        keeper = order({t for line in members for t in texts_of[line]})
        kept_in.update(dict.fromkeys(members, keeper))
    gone = {text: set() for text in first_of}
    again = defaultdict(set)
    said_again = lambda tokens, raw: (raw if raw is not None else " ".join(tokens), len(tokens) >= long)
    for text, at, tokens, raw in lines:
        if tokens in kept_in and kept_in[tokens] != text:
            gone[text].add(at)
        if raw is not None or len(tokens) >= long:
            again[said_again(tokens, raw)].add(text)
    for text, at, tokens, raw in lines:
        same = again.get(said_again(tokens, raw), ())
        if len(same) >= (2 if len(tokens) >= long else min_docs) and order(same) != text:
            gone[text].add(at)
    return gone
