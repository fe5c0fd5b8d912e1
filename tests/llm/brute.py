"""Plain Python versions of the operators, for small fixtures."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def repeats(rows, window=35):
    """(id, n_words, n_removed, kept_sha256) of op5."""
    docs = [(i, words(t)) for i, t in rows]
    count = Counter(tuple(w[s:s + window]) for _, w in docs for s in range(len(w) - window + 1))
    out = []
    for i, w in docs:
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            if count[tuple(w[s:s + window])] > 1:
                gone[s:s + window] = [True] * window
        out.append((i, len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g))))
    return out


SECRETS = {
    "assign": re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A),
    "access": re.compile(r"AKIA[A-Z0-9]+"), "hex": re.compile(r"[0-9a-f]+")}
LEAST = {"assign": 6, "access": 20, "hex": 24}


def secrets(text):
    out = []
    for k, (kind, rule) in enumerate(SECRETS.items()):
        for m in rule.finditer(text or ""):
            if len(m[2] if kind == "assign" else m[0]) >= LEAST[kind]:
                out.append((m.start(), k, m.end(), kind))
    return [(kind, a, b) for a, _, b, kind in sorted(out)]


def quality(text, span=8):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    w = words(text)
    count = Counter(tuple(w[i:i + span]) for i in range(len(w) - span + 1))
    covered = {j for i in range(len(w) - span + 1) if count[tuple(w[i:i + span])] > 1 for j in range(i, i + span)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(covered),
            len(w) < 20 or 100 * len(covered) > 30 * len(w))


def shingles(text, k=5):
    w = words(text)
    if not w:
        return Counter()
    return Counter(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1)))


def near_classes(rows, threshold=0.8):
    """Class sets of (id, text) under weighted Jaccard over tf * ln(1000 + n / df), with exact df."""
    sets = {}
    for i, t in rows:
        sets.setdefault(t or "", []).append(i)
    texts = list(sets)
    grams = [shingles(t) for t in texts]
    df = Counter(g for t, c in zip(texts, grams) for g in c for _ in sets[t])
    n = len(rows)
    weight = [{g: tf * math.log(1000 + n / df[g]) for g, tf in c.items()} for c in grams]
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(texts)):
        for b in range(a):
            low = sum(min(v, weight[b][g]) for g, v in weight[a].items() if g in weight[b])
            if low and low >= threshold * (sum(weight[a].values()) + sum(weight[b].values()) - low):
                parent[root(a)] = root(b)
    out = {}
    for k, t in enumerate(texts):
        out.setdefault(root(k), []).extend(sets[t])
    return sorted(sorted(v) for v in out.values())


def alignment(rows):
    """op11's rows (id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256): whole texts, decoded bytes only."""
    import sentencepiece
    from tokenizers import Tokenizer

    from sparkmart.llm.token_alignment import A_VOCABULARY, B_VOCABULARY

    a, b = Tokenizer.from_file(A_VOCABULARY), sentencepiece.SentencePieceProcessor(model_file=B_VOCABULARY)
    a.encode_special_tokens = True
    latin = [*range(33, 127), *range(161, 173), *range(174, 256)]
    alphabet = {chr(x): x for x in latin}
    alphabet |= {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in latin)}

    def ends(tokens):
        out, at = [], 0
        for t in tokens:
            out.append((at, at + len(t)))
            at += len(t)
        return out

    docs, count = [], Counter()
    for i, text in rows:
        e = a.encode(" " + text, add_special_tokens=False) if text else None
        ids = (e.ids, b.encode(text)) if text else ([], [])
        ta = [bytes(alphabet[c] for c in t) for t in e.tokens] if text else []
        tb = [bytes([int(p[3:5], 16)]) if b.is_byte(k) else p.replace("▁", " ").encode() for k in ids[1] for p in [b.id_to_piece(k)]]
        if not text or not b"".join(ta) == b"".join(tb) == (" " + text).encode():
            docs.append((i, [], [], [], []))
            continue
        sa, sb, links, j = ends(ta), ends(tb), [], 0
        for k, (lo, hi) in enumerate(sa):
            while sb[j][1] <= lo:
                j += 1
            m = j
            while m < len(sb) and sb[m][0] < hi:
                links.append((ids[0][k], ids[1][m]))
                m += 1
        cuts = sorted({x for _, x in sa} & {x for _, x in sb})
        groups, lo = [], 0
        for hi in cuts:
            groups.append("|".join(",".join(str(t) for t, (s, _) in zip(*side) if lo <= s < hi) for side in ((ids[0], sa), (ids[1], sb))))
            lo = hi
        docs.append((i, ids[0], ids[1], groups, links))
        count.update(set(links))
    top = {}
    for (x, _), n in count.items():
        top[x] = max(top.get(x, 0), n)
    return [(i, len(x), len(y), len(g), len(k), sum(count[p] == top[p[0]] for p in k), sum(count[p] for p in k), sha(";".join(g)) if g else "")
            for i, x, y, g, k in docs]


def trie(rows):
    """op13's rows (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) of (conv_id, turn, role, text)."""
    import zlib

    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in own.items()}
    members, ends = {}, {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        path = tuple(own.get(c - int(math.fmod(c, 20)), [])[:h] + turns[h:])
        ends.setdefault(path, []).append(c)
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
    children, leaves, saved = Counter(p[:-1] for p in members if p), Counter(), Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(m) - 1) * len(words(p[-1][1])) if p else 0
    return [(min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p],
             sha(",".join(map(str, sorted(ends.get(p, [])))))) for p, m in members.items()]


def byte_repeats(rows, window=200):
    """op12's rows (id, n_bytes, n_removed, n_spans, kept_sha256)."""
    docs = [(i, (t or "").encode()) for i, t in rows]
    count = Counter(b[s:s + window] for _, b in docs for s in range(len(b) - window + 1))
    out = []
    for i, b in docs:
        kept, spans, gone_to, at = bytearray(), 0, 0, 0
        starts = [s for s in range(len(b) - window + 1) if count[b[s:s + window]] > 1]
        for s in starts:
            if s > gone_to or not spans:
                kept += b[gone_to:s]
                spans += 1
            gone_to = s + window
        kept += b[gone_to:]
        out.append((i, len(b), len(b) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return out


def _template_words(text, units):
    """(plain words, slot types without openers, opener flags, line starts) of op7."""
    out, stop, line = [], True, True
    for piece in re.findall(r"[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text or ""):
        if WORD.fullmatch(piece):
            lead, word, tail = re.fullmatch(r"([!-/:-@\[-`{-~]*)(.*?)([!-/:-@\[-`{-~]*)", piece, re.S).groups()
            bare = re.sub(r"[!-/:-@\[-`{-~]", "", word)
            stop |= any(c in ".!?:" for c in lead)
            if bare:
                low = "".join(c.lower() if c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" or "À" <= c <= "Þ" and c != "×" else c for c in bare)
                name = bare[0] != low[0] and sum(a != b for a, b in zip(bare, low)) == 1 and len(bare.encode()) > 1
                kind = "n" if re.fullmatch("[0-9]+", bare) else "u" if out and out[-1][1] == "n" and low in units else "c" if name and not stop else ""
                out.append((low, kind, name and stop and not kind, line))
                stop = line = False
            stop |= any(c in ".!?:" for c in tail)
        elif "\n" in piece:
            stop = line = True
    return out


def _template_windows(words, size):
    """{(reading key): [(position, reading, slots)]} of all windows of a size."""
    out = {}
    for at in range(len(words) - size + 1):
        part = words[at:at + size]
        if size < 5:
            ends = at + size == len(words) or words[at + size][3]
            if part[0][3] and ends:
                out.setdefault(("plain", *[w[0] for w in part]), []).append((at, 0, ()))
            continue
        for reading in (0, 1):
            kinds = [k or ("c" if reading and o else "") for _, k, o, _ in part]
            if 2 * sum(map(bool, kinds)) > size:
                key, slots = ("plain", *[w[0] for w in part]), ()
                if reading:
                    continue
            else:
                key, slots = tuple((k or "w", "" if k else w[0]) for k, w in zip(kinds, part)), tuple(w[0] for k, w in zip(kinds, part) if k)
            if not reading or any(o for _, _, o, _ in part):
                out.setdefault(key, []).append((at, reading, slots))
    return out


def leaked_items(docs, items, units, cover=0.5):
    """{document: items leaked into it} of op7, every document against every item."""
    found = {d: set() for d, _ in docs}
    parsed = [(i, _template_words(t, units)) for i, t in items]
    for d, text in docs:
        words, cache = _template_words(text, units), {}
        for i, item in parsed:
            n = len(item)
            size = 8 if n >= 24 else min(n, 5)
            if not n:
                continue
            if size not in cache:
                cache[size] = _template_windows(words, size)
            if size < 5:
                if ("plain", *[w[0] for w in item]) in cache[size]:
                    found[d].add(i)
                continue
            shifts = {}
            for key, places in _template_windows(item, size).items():
                for a, r, slots in places:
                    for b, q, other in cache[size].get(key, ()):
                        shifts.setdefault(b - a, []).append((a, r or q, tuple(zip(slots, other))))
            covered = set()
            for hits in shifts.values():
                for some in (hits, [h for h in hits if not h[1]]):
                    pairs = {p for _, _, s in some for p in s}
                    if len(pairs) == len({p[0] for p in pairs}):
                        covered |= {a + k for a, _, _ in some for k in range(size)}
                        break
            if len(covered) >= cover * n:
                found[d].add(i)
    return found


def line_dedup(rows, run):
    """{row number: kept text} of op3 for (id, text) rows whose ids are in row order."""
    seen, out = set(), {}
    for k, (_, text) in enumerate(rows):
        lines = (text or "").split("\n")
        at = [i for i, x in enumerate(lines) if WORD.search(x)]
        keys, gone = [lines[i].strip(" \t\n\v\f\r") for i in at], set()
        for p in range(len(at) - run + 1):
            key = tuple(keys[p:p + run])
            if key in seen:
                gone |= set(at[p:p + run])
            seen.add(key)
        out[k] = "\n".join(x for i, x in enumerate(lines) if i not in gone)
    return out
