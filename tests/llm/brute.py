"""Plain versions of the operators' contracts, for small tables."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter
from fractions import Fraction

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def repeated_bytes(texts, length=400):
    """(n_bytes, n_removed, n_spans, digest of the rest) of every text."""
    data = [(t or "").encode() for t in texts]
    strings = Counter(b[i : i + length] for b in data for i in range(len(b) - length + 1))
    out = []
    for b in data:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if strings[b[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        runs = len(re.findall(rb"\x01+", bytes(gone)))
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out.append((len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def near_groups(rows):
    """(n_shingles, component, kept) of (id, text) rows; ids are not null."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            both = len(x & sets[j])
            if both and 100 * both >= 75 * (len(x) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        least[find(i)] = min(key, least.get(find(i), key))
    return [(len(sets[i]), least[find(i)], least[find(i)] == key) for i, (key, _) in enumerate(rows)]


def contained(documents, items):
    """(doc, item, shared, size) of items of which three quarters lie in a document."""
    sets = [(k, shingles(t)) for k, t in documents]
    out = []
    for item, text in items:
        own = shingles(text)
        for k, s in sets:
            if own and 100 * len(own & s) >= 75 * len(own):
                out.append((k, item, len(own & s), len(own)))
    return sorted(out, key=repr)


def rule_measures(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    count = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(5)}
    n = len(words)
    return (
        n, sum(map(len, words)), sum(c in "#*$%&|<>" for w in words for c in w), sum(x in lines[:i] for i, x in enumerate(lines)), len(covered),
        n < 10 or 100 * len(covered) > 20 * n,
    )


def base_spans(text):
    """Spans of the three kinds that are patterns alone."""
    text = text or ""
    assign = r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    spans = [(m.start(), 0, "assign", m.end()) for m in re.finditer(assign, text) if len(m[1]) >= 12]
    spans += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    spans += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return [(kind, start, end) for start, _, kind, end in sorted(spans)]


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def merkle_leaf(values) -> str:
    return _sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def merkle_tree(leaves: list[str], arity: int = 2) -> tuple[str, list[list[tuple[str, str]]]]:
    """The last node, and for each leaf (before, after) of every level."""
    levels, proofs = [leaves], [[] for _ in leaves]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([_sha("".join(last[i : i + arity])) for i in range(0, len(last), arity)])
    for i, proof in enumerate(proofs):
        for k, level in enumerate(levels[:-1]):
            at = i // arity**k
            run = at - at % arity
            proof.append(("".join(level[run:at]), "".join(level[at + 1 : run + arity])))
    return levels[-1][0], proofs


def merkle(rows, arity: int = 2) -> list[tuple]:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of rows (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append((row[0] is not None, row[0] or 0, merkle_leaf(row), row))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: (sorted(groups[g], key=lambda m: m[:3]), None) for g in order}
    trees = {g: (members, *merkle_tree([m[2] for m in members], arity)) for g, (members, _) in trees.items()}
    root, over = merkle_tree([trees[g][1] for g in order], arity) if order else (None, [])
    out = []
    for g, above in zip(order, over):
        members, subroot, proofs = trees[g]
        for (*_, leaf, row), proof in zip(members, proofs):
            proof, node = proof + above, leaf
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0 and row[3] is not None:
                node = merkle_leaf((*row[:3], row[3] + 1, row[4]))
            for before, after in proof:
                node = _sha(before + node + after)
            out.append((row[0], leaf, subroot, root, _sha("".join(b + a for b, a in proof)), node, node == root))
    return out


def divergence(rows, least: int = 3, top: int = 200) -> list[tuple]:
    """(lang, source, part, item, value, rank) of rows (lang, source, text)."""
    counts, docs = {}, {}
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
        counts.setdefault(lang, {}).setdefault(source, Counter()).update(found)
        docs.setdefault(lang, Counter()).update(set(found))
    out = []
    for lang, sources in counts.items():
        kept = {t for t, n in docs[lang].items() if n >= least}
        own = {s: {t: c[t] for t in kept} for s, c in sources.items()}
        whole = {t: sum(c[t] for c in own.values()) for t in kept}

        def share(c):
            total = sum(c.values()) + len(kept)
            return {t: 1 + 1_000_000_000 * (c[t] + 1) // total for t in kept}

        shares, q = {s: share(c) for s, c in own.items()}, share(whole)
        for s, p in shares.items():
            pairs = [(-sum((p[t] - o[t]) ** 2 // o[t] for t in kept), b.encode(), b) for b, o in shares.items() if b != s]
            single = [(-((p[t] - q[t]) ** 2 // q[t]), t.encode(), t) for t in kept if own[s][t] and p[t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", single, top)):
                out += [(lang, s, part, item, -value, k) for k, (value, _, item) in enumerate(sorted(found)[:most], 1)]
    return out


def interleaved(counts: dict[str | None, int], block: int) -> tuple[Counter, int]:
    """Documents by (slot, source, block), looking at every source in every slot, and the first unbalanced slot.

    Weights are square roots of the counts, as exact fractions of floats.
    """
    whole = sum(Fraction(n**0.5) for n in counts.values())
    share = {s: Fraction(n**0.5) / whole for s, n in counts.items()}
    done, out, last = Counter(), Counter(), {}
    slot = 0
    # a block past each source's full ones, empty or not, is scheduled too
    while len(last) < len(counts):
        free = [s for s in counts if s not in last and math.floor(done[s] / share[s]) <= slot]
        if free:
            s = min(free, key=lambda s: (math.ceil((done[s] + 1) / share[s]), s is not None, s or ""))
            if done[s] == counts[s] // block:
                last[s] = slot
            if size := min(block, counts[s] - done[s] * block):
                out[slot, s, done[s]] = size
            done[s] += 1
        slot += 1
    return out, min(last.values())
