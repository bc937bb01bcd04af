"""Plain versions of the operators, for small inputs."""

import collections
import hashlib
import re

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LAST = 2**63 - 1


def words(text):
    return WORDS.findall(text or "")


def repeated_windows(rows, window):
    """(doc_id, n_words, n_removed, kept) for rows of (doc_id, text)."""
    lists = [words(t) for _, t in rows]
    count = collections.Counter(tuple(w[i : i + window]) for w in lists for i in range(len(w) - window + 1))
    out = []
    for (doc, _), w in zip(rows, lists):
        gone = set()
        for i in range(len(w) - window + 1):
            if count[tuple(w[i : i + window])] > 1:
                gone |= set(range(i, i + window))
        out.append((doc, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


def jaccard_components(rows, n, num, den):
    """(doc_id, n_shingles, component_id)."""
    sets = []
    for _, text in rows:
        w = [x.encode().lower() for x in words(text)]
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    root = {d: d for d, _ in rows if d is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and rows[i][0] is not None and rows[j][0] is not None and den * both >= num * (len(a) + len(sets[j]) - both):
                x, y = find(rows[i][0]), find(rows[j][0])
                root[max(x, y)] = min(x, y)
    return [(d, len(s), None if d is None else find(d)) for (d, _), s in zip(rows, sets)]


def later_lines(rows, min_words):
    """(doc_id, text, n_lines, n_removed): every run of lines is compared with all earlier ones."""
    key = lambda d, t: (LAST if d is None else d, hashlib.md5((t or "").encode()).digest())
    docs = {key(d, t): t or "" for d, t in rows}
    gone, seen = collections.defaultdict(set), set()
    for k in sorted(docs):
        lines = [x for x in docs[k].split("\n") if words(x)]
        sizes = [len(words(x)) for x in lines]
        for i in range(len(lines)):
            for j in range(i + 1, len(lines) + 1):
                if sum(sizes[i:j]) >= min_words and tuple(lines[i:j]) in seen:
                    gone[k] |= set(range(i, j))
            seen |= {tuple(lines[i:j]) for j in range(i + 1, len(lines) + 1)}
    out = []
    for d, t in rows:
        n, kept = 0, []
        for line in (t or "").split("\n"):
            if words(line):
                n += 1
                if n - 1 in gone[key(d, t)]:
                    continue
            kept.append(line)
        out.append((d, None if t is None else "\n".join(kept), n, len(gone[key(d, t)])))
    return out


def base_spans(text):
    """(start, order of kind, end, kind) by the plain expressions."""
    found = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        found.append((m.start(), 0, m.end(), "email"))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            found.append((m.start(), 1, m.end(), "ip"))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 12 <= len(d) <= 19 and sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(d[::-1])) % 10 == 0:
            found.append((m.start(), 2, m.end(), "card"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            found.append((m.start(), 3, m.end(), "phone"))
    return sorted(found)


def quality_counts(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    w = words(text)
    count = collections.Counter(zip(w, w[1:], w[2:]))
    inside = {k for i in range(len(w) - 2) if count[tuple(w[i : i + 3])] > 1 for k in range(i, i + 3)}
    seen, repeated = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            repeated += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), repeated, len(inside)
