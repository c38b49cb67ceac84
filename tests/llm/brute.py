"""Plain Python versions of the operators' results, and a small fixture with awkward rows."""

from __future__ import annotations

import hashlib
import random
import re

from pyspark.sql import types as T

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                       T.StructField("n_chars", T.LongType()),
                       # extra columns whose names clash with result columns
                       T.StructField("score", T.StringType()), T.StructField("n_lines", T.StringType()),
                       T.StructField("size", T.StringType()), T.StructField("node", T.StringType())])


def sha(s: str) -> str:
    return hashlib.sha256(s.encode()).hexdigest()


def sentence(rng, n):
    return " ".join(rng.choice(VOCAB) for _ in range(n))


VOCAB = [a + b for a in ("ka", "Lo", "mi", "ne", "Éta", "ru", "so", "tu") for b in ("ra", "ven", "dil", "po", "x", "zz", "ß")]


def corpus(seed: int = 7, hot: int = 40):
    """Rows (doc_id, text, lang, source, n_chars, extras): copies, near copies, shared lines, null and empty texts."""
    rng = random.Random(seed)
    texts: list[str | None] = []
    base = sentence(rng, 120)
    for _ in range(hot):                                   # a hot group: a third of all rows are exact copies
        texts.append(base)
    for _ in range(12):                                    # near copies: one word changed
        w = base.split(" ")
        w[rng.randrange(120)] = "changed" + str(rng.randrange(1000))
        texts.append(" ".join(w))
    line = "This line stands in very many documents."
    for k in range(30):
        body = [sentence(rng, rng.randrange(1, 40)) for _ in range(rng.randrange(1, 6))]
        if k % 2:
            body.insert(rng.randrange(len(body) + 1), rng.choice([line, "  " + line.upper() + "\t", line]))
        texts.append("\n".join(body))
    texts += [None, "", "   ", "\n\n", "one", "two words", "one", "a b c d", "A B C D", " a  b\tc d ", "ab\n" * 30, "x " * 400,
              "line repeated here\nline repeated here\nline repeated here", sentence(rng, 6000), "ÀÉÎ " * 20 + "éé"]
    passage = sentence(rng, 70)
    texts += [sentence(rng, 60) + " " + passage + " " + sentence(rng, 45), passage + "\n" + sentence(rng, 80)]
    rows = [(i * 3 + 1, t, "en", [f"src{i % 4}", None][i % 9 == 8], len(t or ""), "s", "l", "z", "n") for i, t in enumerate(texts)]
    rows.append(rows[0])                                    # a repeated row
    return rows


def words(text):
    return WORD.findall(text or "")


def shingle_set(text, k=5):
    w = words((text or "").translate(FOLD))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1)))


def jaccard_components(rows):
    """(doc_id, n_shingles, component_id), sorted, from all pairs."""
    sets = [shingle_set(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(least.get(find(i), r[0]), r[0])
    return sorted((r[0], len(s), least.get(find(i))) for i, (r, s) in enumerate(zip(rows, sets)) if r[0] is not None)


def line_key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(FOLD)


def dedup_lines(rows):
    """(doc_id, n_lines, n_dropped, kept text) per row."""
    held: dict[str, set] = {}
    for r in rows:
        for x in (r[1] or "").split("\n"):
            held.setdefault(line_key(x), set()).add(r[0])
    gone = {k: min(v) for k, v in held.items() if len(k) >= 10 and len(v) > 1}
    out = []
    for r in rows:
        ls = (r[1] or "").split("\n")
        kept = [x for x in ls if gone.get(line_key(x), r[0]) == r[0]]
        out.append((r[0], len(ls), len(ls) - len(kept), "\n".join(kept)))
    return sorted(out)


def base_counts(text):
    text = text or ""
    w = words(text)
    lines, dup = set(), 0
    for x in text.split("\n"):
        if words(x):
            dup += x in lines
            lines.add(x)
    seen: dict[tuple, list] = {}
    for i in range(len(w) - 2):
        seen.setdefault(tuple(w[i:i + 3]), []).append(i)
    rep = {j for v in seen.values() if len(v) > 1 for i in v for j in (i, i + 1, i + 2)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(rep)


ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def contamination(rows, items):
    wins = []
    for item, text in items:
        w = ITEM_WORD.findall((text or "").translate(FOLD))
        n = min(10, len(w))
        wins += [(item, w[i:i + n]) for i in range(len(w) - n + 1)] if w else []
    out = []
    for r in rows:
        w = ITEM_WORD.findall((r[1] or "").translate(FOLD))
        hit, ids = set(), set()
        for item, x in wins:
            for i in range(len(w) - len(x) + 1):
                if w[i:i + len(x)] == x:
                    hit.update(range(i, i + len(x)))
                    ids.add(item)
        ids = sorted(str(i) for i in ids if i is not None)
        out.append((r[0], len(w), len(hit), len(ids), sha(",".join(ids)), bool(hit)))
    return sorted(out)


def secret_spans(text):
    """Base spans by the contract's own patterns: match first, drop short matches after."""
    text, out = text or "", []
    for m in re.finditer(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text, re.I | re.A):
        if len(m[2]) >= 6:
            out.append((m.start(), 0, "assign", m.end()))
    for m in re.finditer(r"AKIA[A-Z0-9]+", text):
        if len(m[0]) >= 20:
            out.append((m.start(), 1, "access", m.end()))
    for m in re.finditer(r"[0-9a-f]+", text):
        if len(m[0]) >= 24:
            out.append((m.start(), 2, "hex", m.end()))
    return [f"{k}:{s}:{e}" for s, _, k, e in sorted(out)]


def planted_words(doc_id, text):
    """Words of a document behind the planted repetition of the run query."""
    import binascii

    w = words(text)
    if doc_id is None or not w:
        return w
    h = binascii.crc32(str(doc_id).encode())
    if h % 10:
        return w
    g, n = h // 10, len(w)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]


def periodic_runs(w, shortest=24):
    """All runs (start, length, period) by trying every period; the smallest period of equal stretches stays."""
    best = {}
    for q in range(1, len(w) // 3 + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(shortest, 3 * q):
                best.setdefault((i, j + q), q)
            i = j
    return sorted((s, e - s, q) for (s, e), q in best.items())


def run_digest(doc_id, w):
    runs = periodic_runs(w)
    drop = {i for s, n, q in runs for i in range(s + q, s + n)}
    top = None
    for s, n, q in runs:
        if top is None or n * top[2] > top[1] * q:
            top = (s, n, q)
    best = (*top, 1000 * top[1] // top[2]) if top else (None,) * 4
    return (doc_id, len(runs), *best, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)),
            sha(" ".join(x for i, x in enumerate(w) if i not in drop)))


def damaged(rows):
    """Conversation rows (conv_id, turn, role, text) behind the contract's damage."""
    import binascii

    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        h = binascii.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if h == 0:
            continue
        if h == 1:
            text = ""
        elif h == 2:
            text = re.sub("[.!?]", "", text)
        elif h == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if h == 3 else 1)
    return out


def cheapest_audit(rows):
    """(cost, audit, repaired lines) by the plainest recursion: least cost, then least audit, over every edit."""
    n = len(rows)
    best = [[None] * 4 for _ in range(n + 1)]
    role_of = {0: ("user", 2), 1: ("user", 2), 3: ("user", 2), 2: ("assistant", 3)}

    def close(i):
        for _ in range(3):
            for s in range(4):
                role, t = role_of[s]
                if best[i][t] is not None:
                    c, a, lines = best[i][t]
                    new = (c + 3, "I" + a, [role + ":", *lines])
                    if best[i][s] is None or new[:2] < best[i][s][:2]:
                        best[i][s] = new

    best[n][0] = best[n][3] = (0, "", [])
    close(n)
    for i in range(n - 1, -1, -1):
        role, text, fault = rows[i]
        for s in range(4):
            options = [("D", 4, s, [])]
            if fault not in ("blank", "duplicate"):
                more = 3 if fault == "truncated" else 0
                expected, t = role_of[s]
                if role[:1] == expected[0]:
                    options.append(("K", more, t, [f"{role}:{text}"]))
                if role[:1] == "s" and s == 0:
                    options.append(("K", more, 1, [f"{role}:{text}"]))
                options.append(("R", 3 + more, t, [f"{expected}:{text}"]))
            found = [(c + best[i + 1][t][0], e + best[i + 1][t][1], line + best[i + 1][t][2]) for e, c, t, line in options if best[i + 1][t]]
            best[i][s] = min(found, key=lambda x: x[:2]) if found else None
        close(i)
    return best[0][0]


def repair_digest(original, after, tie=lambda r: 0):
    """Contract rows of the repair query; ``tie`` orders rows of one turn."""
    out = []
    for conv in sorted({r[0] for r in original}, key=str):
        rows = sorted((r for r in after if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, tie(r)))
        faults, seen = [], set()
        for _, _, role, text in rows:
            solid = text.rstrip(" \t\n\v\f\r")
            faults.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else None)
            seen.add((role, text))
        turns = [r[1] for r in rows if r[1] is not None]
        initials = [r[2][:1] for r in rows]
        cost, audit, lines = cheapest_audit([(r[2], r[3], f) for r, f in zip(rows, faults)])
        out.append((conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
                    sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit, sha("\n".join(lines))))
    return out
