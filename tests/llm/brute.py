"""Plain Python versions of the operators' results, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACE = " \t\n\x0b\x0c\r"


def sha(text: str | bytes) -> str:
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def bpe(docs, file):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(file)
    t.no_truncation(), t.no_padding()
    for i, text in docs:
        ids = t.encode(text or "", add_special_tokens=False).ids
        yield i, len(ids), sha(",".join(map(str, ids))), sha(t.decode(ids, skip_special_tokens=False))


def byte_dedup(docs, size=100):
    firsts = {}
    ordered = sorted(((i, (t or "").encode()) for i, t in docs), key=lambda d: d[0])
    for i, data in ordered:
        for at in range(len(data) - size + 1):
            firsts.setdefault(data[at : at + size], (i, at))
    for i, data in ordered:
        gone = [False] * len(data)
        for at in range(len(data) - size + 1):
            if firsts[data[at : at + size]] < (i, at):
                gone[at : at + size] = [True] * size
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        yield i, len(data), sum(gone), spans, sha(bytes(b for b, g in zip(data, gone) if not g))


def substring_dedup(docs, size=50):
    lists = {i: WORD.findall(t or "") for i, t in docs}
    first = {}
    for i in sorted(lists):
        for at in range(len(lists[i]) - size + 1):
            first.setdefault(tuple(lists[i][at : at + size]), i)
    for i, words in lists.items():
        gone = [False] * len(words)
        for at in range(len(words) - size + 1):
            if first[tuple(words[at : at + size])] < i:
                gone[at : at + size] = [True] * size
        yield i, len(words), sum(gone), sha(" ".join(w for w, g in zip(words, gone) if not g))


def line_dedup(docs, min_docs=10):
    key = lambda line: line.strip(SPACE).translate(UPPER)
    split = [(i, (t or "").split("\n")) for i, t in docs]
    n = Counter(k for _, ls in split for k in {key(line) for line in ls} if k)
    for i, ls in split:
        kept = [line for line in ls if n[key(line)] < min_docs]
        yield i, len(ls), len(ls) - len(kept), sha("\n".join(kept))


def repeated(words, size):
    n = Counter(tuple(words[a : a + size]) for a in range(len(words) - size + 1))
    hit = [False] * len(words)
    for a in range(len(words) - size + 1):
        if n[tuple(words[a : a + size])] > 1:
            hit[a : a + size] = [True] * size
    return hit


def quality(docs, max_longest=100):
    for i, t in docs:
        t = t or ""
        words = WORD.findall(t)
        lines = [line for line in t.split("\n") if WORD.search(line)]
        hit = repeated(words, 8)
        chars, shared = sum(map(len, words)), sum(len(w) for w, h in zip(words, hit) if h)
        failed = len(words) < 20 or 100 * sum(hit) > 30 * len(words)
        kept = not failed and shared <= 0.3 * chars and not any(repeated(words, max_longest + 1))
        yield i, len(words), chars, len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), sum(hit), failed, kept


def decontamination(docs, items, size=13):
    windows = defaultdict(set)
    for item, t in items:
        words = ITEM_WORD.findall((t or "").translate(UPPER))
        for a in range(max(len(words) - size + 1, 1) if words else 0):
            windows[tuple(words[a : a + size])].add("" if item is None else str(item))
    for i, t in docs:
        words, found = ITEM_WORD.findall((t or "").translate(UPPER)), set()
        hit = [False] * len(words)
        for n in {len(w) for w in windows}:
            for a in range(len(words) - n + 1):
                if tuple(words[a : a + n]) in windows:
                    hit[a : a + n] = [True] * n
                    found |= windows[tuple(words[a : a + n])]
        yield i, len(words), sum(hit), len(found), sha(",".join(sorted(found))), sum(hit) > 0 and 20 * sum(hit) >= len(words)


def simhash(docs, size=4, radius=4):
    prints = []
    for i, t in docs:
        words = WORD.findall((t or "").translate(UPPER))
        parts = [" ".join(words[a : a + size]) for a in range(max(len(words) - size + 1, 1) if words else 0)]
        hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
        prints.append((i, sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))))
    root = {i: i for i, _ in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, (i, a) in enumerate(prints):
        for j, b in prints[:k]:
            if (a ^ b).bit_count() <= radius:
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return [(i, f"{fp:016x}", find(i)) for i, fp in prints]


def chat(rows):
    spoken = defaultdict(list)
    for k, (conv, turn, role, text) in enumerate(rows):
        spoken[(conv, k if conv is None else None)].append((turn, role or "", text or ""))
    for (conv, _), turns in spoken.items():
        turns.sort()
        said = "".join(t for _, r, t in turns if r == "assistant")
        yield conv, len(turns), sha("".join(f"{r}\n{t}\n" for _, r, t in turns)), len(said), sha(said)


def base_scores(docs, held_out):
    """(id, n_tokens, n_known, train_tokens, base_score)."""
    from math import log10

    end = object()
    tokens = {i: [*WORD.findall((t or "").translate(UPPER)), end] for i, t in docs}
    counts = Counter(w for i, ws in tokens.items() if i not in held_out for w in ws)
    total = sum(counts.values())
    for i, ws in tokens.items():
        yield i, len(ws), sum(counts[w] > 0 for w in ws), total, sum(log10((counts[w] + 0.5) / (total + 0.5 * (len(counts) + 1))) for w in ws)


UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def fill_in_middle(docs):
    for i, t in docs:
        t = t or ""
        units = UNIT.findall(t)
        digest = sha(f"42:{'' if i is None else i}")
        a, b, c, d = (int(digest[k : k + 8], 16) for k in range(0, 32, 8))
        low, high = sorted((a % (len(units) + 1), b % (len(units) + 1)))
        prefix, middle, suffix = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
        if not t or any(s in t for s in ("<P>", "<S>", "<M>")) or c % 100 >= 50:
            yield i, len(units), "plain", None, None, sha(t), sha(t)
        elif d % 100 < 80:
            yield i, len(units), "spm", len(prefix), len(middle), sha(f"<S>{suffix}<P>{prefix}<M>{middle}"), sha(t)
        else:
            yield i, len(units), "psm", len(prefix), len(middle), sha(f"<P>{prefix}<S>{suffix}<M>{middle}"), sha(t)


TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def divergence(docs, min_docs=30, top=50):
    """docs: (text, lang, source)."""
    docs = [(TERM.findall((t or "").translate(UPPER)), lang or "", source or "") for t, lang, source in docs]
    for lang in sorted({d[1] for d in docs}):
        held, counts, whole = Counter(), defaultdict(Counter), Counter()
        for terms, own, source in docs:
            if own == lang:
                held.update(set(terms))
                counts[source].update(terms)
                whole.update(terms)
        kept = [t for t, n in held.items() if n >= min_docs]

        def p(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 5) // (total + 5 * len(kept)) for t in kept}

        shares, q = {s: p(c) for s, c in counts.items()}, p(whole)
        for source, mine in shares.items():
            found = {
                "pair": [(sum(abs(mine[t] - theirs[t]) for t in kept), other) for other, theirs in shares.items() if other != source],
                "term": [(mine[t] - q[t], t) for t in kept if counts[source][t] and mine[t] > q[t]],
            }
            for part, values in found.items():
                values.sort(key=lambda v: (-v[0], v[1].encode()))
                for rank, (value, item) in enumerate(values if part == "pair" else values[:top], 1):
                    yield lang, source, part, item, value, rank


LETTERS = re.compile(r"[A-Za-z\x80-\U0010ffff]+")
#: The first code point of each range, and the number of the script it belongs to.
SCRIPTS = [
    (0x80, 0), (0xC0, 1), (0x280, 11), (0x380, 2), (0x400, 3), (0x500, 11), (0x5C0, 4), (0x600, 5), (0x700, 11), (0x900, 6), (0xE00, 7),
    (0xF00, 11), (0x3000, 9), (0x3040, 8), (0x3100, 9), (0xA000, 10), (0xE000, 11),
]


def script(char):
    return 1 if ord(char) < 0x80 else max((at, s) for at, s in SCRIPTS if at <= ord(char))[1]


def buckets(word):
    """The trigram bucket of each byte of a word between two spaces."""
    data = b" " + word.encode() + b" "
    return [(int.from_bytes(data[k - 1 : k + 2]) * 0x9E3779B1 & 0xFFFFFFFF) >> 16 for k in range(1, len(data) - 1)]


def language_id(docs, penalty=12.0):
    """docs: (doc_id, text, lang). (doc_id, lang_pred, score), learned from texts whose crc32(doc_id) mod 4 is not 2."""
    from math import log
    from zlib import crc32

    grams, scripts = defaultdict(Counter), defaultdict(Counter)
    for i, text, lang in docs:
        if lang is not None and text is not None and crc32(str(i).encode()) % 4 != 2:
            words = LETTERS.findall(text.lower())
            grams[lang].update(b for w in words for b in buckets(w))
            scripts[lang].update(max(map(script, w)) for w in words)
    languages = sorted(grams)
    total = {a: sum(grams[a].values()) for a in languages}
    uses = {s: [a for a in languages if scripts[a][s] and scripts[a][s] >= 0.01 * sum(scripts[a].values())] for s in range(12)}
    for i, text, _ in docs:
        words = LETTERS.findall((text or "").lower())
        if not any(map(str.isalpha, text or "")) or not words:
            yield i, "und", 0.0
            continue
        best, back = None, []
        for word in words:
            allowed = uses[max(map(script, word))] or languages
            own = buckets(word)
            score = {a: sum(log((grams[a][b] + 0.1) / (total[a] + 0.1 * 65536)) for b in own) - (0 if a in allowed else 1e4) for a in languages}
            if best is None:
                best = score
                continue
            top = max(languages, key=lambda a: best[a])
            back.append({a: a if best[a] >= best[top] - penalty else top for a in languages})
            best = {a: max(best[a], best[top] - penalty) + score[a] for a in languages}
        path = [max(languages, key=lambda a: best[a])]
        for step in reversed(back):
            path.append(step[path[-1]])
        bytes_in = Counter()
        for word, lang in zip(words, reversed(path)):
            bytes_in[lang] += len(word.encode())
        main = min(languages, key=lambda a: (-bytes_in[a], a))
        yield i, main, bytes_in[main] / sum(bytes_in.values())
