"""Plain-Python statements of what the operators compute, for small inputs."""

import collections
import hashlib
import math
import re
import zlib

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0], (r[1] or "").encode()))


def remove_repeats(rows, span=100):
    """[(id, kept bytes, removed, spans)] in order."""
    seen, out = set(), []
    for doc_id, text in ordered(rows):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - span + 1):
            string = data[p:p + span]
            if string in seen:
                gone[p:p + span] = b"\1" * span
            seen.add(string)
        kept = bytes(c for c, g in zip(data, gone) if not g)
        spans = sum(1 for p in range(len(gone)) if gone[p] and not (p and gone[p - 1]))
        out.append((doc_id, kept, sum(gone), spans))
    return out


def shingle_set(text, size):
    words = [w.encode().lower() for w in WORD.findall(text or "")]
    if not words:
        return frozenset()
    return frozenset(zip(*(words[i:] for i in range(size)))) if len(words) >= size else frozenset([tuple(words)])


def components(sets, size_percent):
    """Smallest id reachable, for {id: set}."""
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= size_percent * len(sets[a] | sets[b]):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {i: root(i) for i in sets}


def quality(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, surviving text."""
    text = text or ""
    words = WORD.findall(text)
    chars = sum(map(len, words))
    lines = text.split("\n")
    worded = [x for x in lines if WORD.search(x)]
    grams = collections.defaultdict(list)
    for i in range(len(words) - 4):
        grams[tuple(words[i:i + 5])].append(i)
    inside = {i + d for at in grams.values() if len(at) > 1 for i in at for d in range(5)}

    def passes(line):
        n = len(WORD.findall(line))
        if not n:
            return True
        marks = sum(line.count(c) for c in "|»›•·")
        runs = len(re.findall(r"[!?]{2,}|\.{4,}", line))
        symbols = sum(line.count(c) for c in "#*$%&|<>")
        own = sum(map(len, WORD.findall(line)))
        phrases = ("all rights reserved", "cookie policy", "privacy policy", "terms of use", "terms of service",
                   "enable javascript", "lorem ipsum", "click here", "sign up", "log in", "subscribe now", "skip to content")
        return not (
            (marks >= 3 and marks * 4 >= n) or (runs >= 3 and runs * 4 >= n) or (symbols >= 5 and symbols * 10 >= own)
            or (n < 8 and not re.search("[.!?:;,…]", line))
            or (n < 30 and any(p in line.lower() for p in phrases))
        )

    left = "\n".join(x for x in lines if passes(x))
    failed = len(words) < 10 or 100 * len(inside) > 20 * len(words)
    lost = chars - sum(map(len, WORD.findall(left)))
    return (len(words), chars, sum(text.count(c) for c in "#*$%&|<>"), len(worded) - len(set(worded)), len(inside),
            failed, not failed and not lost * 100 > chars * 30, left)


def mix(rows):
    """{id: times taken} and {source: (size, target)} of (id, size, source) rows."""
    sizes = collections.defaultdict(int)
    for _, size, source in rows:
        sizes[source] += size
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, left, free = {}, 1.5 * sum(sizes.values()), set(names)
    while True:
        level = left / sum(weight[s] for s in free) if free else 0
        over = {s for s in free if level * weight[s] > 2 * sizes[s]}
        if not over:
            break
        for s in over:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        free -= over
    target.update({s: level * weight[s] for s in free})
    return {s: (sizes[s], target[s]) for s in names}


class Ppm:
    def __init__(self, texts, order):
        self.order, self.tables, self.words = order, [collections.defaultdict(collections.Counter) for _ in range(order + 1)], collections.Counter()
        for data in texts:
            symbols = self.symbols(data)
            for p in range(order, len(symbols)):
                for k in range(order + 1):
                    self.tables[k][symbols[p - k:p]][symbols[p]] += 1
            self.words.update([*data.lower().split(), None])

    def symbols(self, data):
        return (0,) * self.order + tuple(data.lower()) + (256,)

    def score(self, data):
        symbols, total = self.symbols(data), 0.0
        for p in range(self.order, len(symbols)):
            gone = set()
            for k in range(self.order, -1, -1):
                seen = self.tables[k].get(symbols[p - k:p], {})
                rest = {s: n for s, n in seen.items() if s not in gone}
                whole = 2 * sum(rest.values())
                if symbols[p] in rest:
                    total += math.log10((2 * rest[symbols[p]] - 1) / whole)
                    break
                if rest:
                    total += math.log10(len(rest) / whole)
                gone |= set(seen)
            else:
                total -= math.log10(257 - len(gone))
        return total

    def base(self, data):
        n, v = sum(self.words.values()), len(self.words)
        tokens = [*data.lower().split(), None]
        return len(tokens), sum(self.words[t] > 0 for t in tokens), n, sum(math.log10((self.words[t] + 1) / (n + v + 1)) for t in tokens)


def crc(doc_id):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode())


def sha(data):
    return hashlib.sha256(data).hexdigest()
