"""Plain Python versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
NO_ID = 1 << 63


def words(text):
    return WORD.findall(text or "")


def sha(text):
    data = text if isinstance(text, bytes) else text.encode()
    return hashlib.sha256(data).hexdigest()


def ascii_lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def exact_dedup(rows, keep):
    """rows: (doc_id, text). Sorted (doc_id, keep_id, group_size, kept, text_sha256)."""
    groups = defaultdict(list)
    for doc, text in rows:
        groups[ascii_lower(text)].append(doc)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep_id = keep(known) if known else None
        left = 1
        for i in ids:
            stays = i == keep_id and left == 1
            left -= stays
            out.append((i, keep_id, len(ids), stays, sha(text)))
    return sorted(out, key=repr)


def repeated_phrases(rows, size=13):
    owner = {}
    for doc, text in rows:
        w = words(text)
        for i in range(len(w) - size + 1):
            k = tuple(w[i : i + size])
            owner[k] = min(owner.get(k, NO_ID), NO_ID if doc is None else doc)
    out = []
    for doc, text in rows:
        w = words(text)
        gone = [False] * len(w)
        for i in range(len(w) - size + 1):
            if owner[tuple(w[i : i + size])] < (NO_ID if doc is None else doc):
                gone[i : i + size] = [True] * size
        out.append((doc, len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g))))
    return sorted(out, key=repr)


def repeated_strings(rows, size=200):
    seen = Counter()
    data = [(doc, (text or "").encode()) for doc, text in rows]
    for _, b in data:
        seen.update(b[i : i + size] for i in range(len(b) - size + 1))
    out = []
    for doc, b in data:
        gone = bytearray(len(b))
        for i in range(len(b) - size + 1):
            if seen[b[i : i + size]] > 1:
                gone[i : i + size] = b"\1" * size
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((doc, len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), sha(kept)))
    return sorted(out, key=repr)


def shingles(text, size=5):
    w = words(text)
    return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1)) or (
        frozenset([tuple(w)]) if w else frozenset()
    )


def similar(rows, threshold=0.8):
    """Per row: (doc_id, class_id, n_links, n_text_links); rows is a list of (doc_id, text)."""
    sets = [shingles(text) for _, text in rows]
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    links = [0] * len(rows)
    kinds = [set() for _ in rows]
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and len(a & b) / len(a | b) >= threshold:
                links[i] += 1
                links[j] += 1
                if a != b:
                    kinds[i].add(b)
                    kinds[j].add(a)
                label[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for i, (doc, _) in enumerate(rows):
        key = NO_ID if doc is None else doc
        least[root(i)] = min(least.get(root(i), NO_ID), key)
    out = []
    for i, (doc, _) in enumerate(rows):
        c = least[root(i)]
        out.append((doc, None if c == NO_ID else c, links[i], len(kinds[i])))
    return sorted(out, key=repr)


def mix(rows, weights=(5, 2, 1), cap=3):
    """Targets per source by repeated resharing: {source: (size, target)}."""
    sizes = Counter()
    for _, source, text in rows:
        sizes[source] += len(words(text))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, free, left = {}, set(order), sum(sizes.values())
    while free:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        full = {s for s in free if share[s] > cap * sizes[s]}
        if not full:
            target.update(share)
            break
        for s in full:
            target[s] = cap * sizes[s]
            left -= target[s]
        free -= full
    return {s: (sizes[s], target[s]) for s in order}


def repeated_lines(rows, min_chars=40, min_docs=5):
    """Sorted (doc_id, n_lines, n_dropped, text)."""

    def key(line):
        return ascii_lower(line.strip(" \t\n\x0b\x0c\r"))

    holders = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            holders[key(line)].add(doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = []
        for line in lines:
            k = key(line)
            owner = max(holders[k], key=lambda d: (d is not None, d or 0))
            if len(k) < min_chars or len(holders[k]) < min_docs or owner == doc:
                kept.append(line)
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def alignment(rows, first, second):
    """Sorted (doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups)."""
    import sentencepiece
    from tokenizers import Tokenizer

    a_model, b_model = Tokenizer.from_file(first), sentencepiece.SentencePieceProcessor(model_file=second)
    a_model.encode_special_tokens = True
    letters, spare = {}, 256
    for b in range(256):
        if chr(b).isprintable() and b not in (32, 173) and not 127 <= b <= 160:
            letters[chr(b)] = b
    for b in range(256):
        if b not in letters.values():
            letters[chr(spare)] = b
            spare += 1

    def a_tokens(text):
        ids = a_model.encode(" " + text, add_special_tokens=False).ids
        return [(i, bytes(letters[c] for c in a_model.id_to_token(i))) for i in ids]

    def b_token(i):
        piece = b_model.id_to_piece(i)
        return bytes([int(piece[3:-1], 16)]) if b_model.is_byte(i) else piece.replace("\u2581", " ").encode()

    def places(tokens):
        out, end = [], 0
        for i, data in tokens:
            out.append((i, end, end + len(data)))
            end += len(data)
        return out

    total, per = Counter(), []
    for doc, text in rows:
        a, b = a_tokens(text or ""), [(i, b_token(i)) for i in b_model.encode(text or "")]
        whole = (" " + (text or "")).encode()
        if not text or {whole} != {b"".join(x for _, x in a), b"".join(x for _, x in b)}:
            a = b = []
        a, b = places(a), places(b)
        links = [(i, j) for i, s, e in a for j, t, u in b if s < u and t < e]
        total.update(links)
        groups, start = [], 0
        for cut in sorted({e for *_, e in a} & {e for *_, e in b}):
            parts = (",".join(str(i) for i, s, e in x if start <= s and e <= cut) for x in (a, b))
            groups.append("|".join(parts))
            start = cut
        per.append((doc, len(a), len(b), len(groups), links, ";".join(groups)))
    best = Counter()
    for (_, j), n in total.items():
        best[j] = max(best[j], n)
    return sorted(
        (
            (d, na, nb, ng, len(ls), sum(total[x] == best[x[1]] for x in ls), sum(total[x] for x in ls), g)
            for d, na, nb, ng, ls, g in per
        ),
        key=repr,
    )


def spelling(rows, typos=97, min_length=5, min_count=3, ratio=2):
    """Sorted (word, form, root, n, n_near, form_n)."""
    counts = Counter()
    for doc, text in rows:
        for word in re.findall("[A-Za-z\u00c0-\u00ff]+", text or ""):
            word = ascii_lower(word)
            h = zlib.crc32(f"{'' if doc is None else doc}:{word}".encode())
            if typos and h % typos == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            counts[word] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= min_length and n >= min_count}
    near, holes = defaultdict(set), defaultdict(set)
    for word in counts:
        for i in range(len(word)):
            rest = word[:i] + word[i + 1 :]
            holes[i, rest].add(word)
            if rest in counts:
                near[word].add(rest)
                near[rest].add(word)
    for group in holes.values():
        for word in group:
            near[word] |= group - {word}
    forms = {}
    for word, n in counts.items():
        most, form = min(((-counts[x], x) for x in near[word]), default=(0, None))
        forms[word] = form if form and -most >= ratio * n else None
    out = []
    for word, n in counts.items():
        root = word
        while forms[root]:
            root = forms[root]
        out.append((word, forms[word], root, n, len(near[word]), counts.get(forms[word])))
    return sorted(out, key=repr)
