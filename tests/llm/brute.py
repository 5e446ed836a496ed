"""Plain Python versions of the operators, straight from their definitions."""

import hashlib
import re
import zlib

import xxhash

WORD = "[^\x20\x09-\x0D]+"


def words(text):
    return re.findall(WORD, text or "")


def fingerprint(text, size=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = words(low)
    if not w:
        return 0
    shingles = [" ".join(w[i : i + size]) for i in range(len(w) - size + 1)] or [" ".join(w)]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(prints, bits=3):
    """Smallest id reachable for each id of a dict of fingerprints."""
    ids = sorted(prints)
    label = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for i in ids:
            for j in ids:
                if label[j] < label[i] and (prints[i] ^ prints[j]).bit_count() <= bits:
                    label[i] = label[j]
                    changed = True
    return label


def cut(rows, size=13):
    """(n_words, n_removed, sha) per id of unique ids; a null id comes last."""
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    first = {}
    for place, (_, text) in enumerate(order):
        w = words(text)
        for i in range(len(w) - size + 1):
            first.setdefault(tuple(w[i : i + size]), place)
    out = {}
    for place, (doc, text) in enumerate(order):
        w = words(text)
        gone = [False] * len(w)
        for i in range(len(w) - size + 1):
            if first[tuple(w[i : i + size])] < place:
                gone[i : i + size] = [True] * size
        kept = [x for x, g in zip(w, gone) if not g]
        out[doc] = (len(w), len(w) - len(kept), hashlib.sha256(" ".join(kept).encode()).hexdigest())
    return out


def repeats(rows, size):
    """Merged spans of words in windows that another id has too."""
    seen = {}
    for doc, text in rows:
        w = words(text)
        for i in range(len(w) - size + 1):
            seen.setdefault(tuple(w[i : i + size]), set()).add(doc)
    out = {}
    for doc, text in rows:
        w, spans = words(text), []
        for i in range(len(w) - size + 1):
            if len(seen[tuple(w[i : i + size])]) > 1:
                if spans and i <= spans[-1][1]:
                    spans[-1] = (spans[-1][0], i + size)
                else:
                    spans.append((i, i + size))
        if spans:
            out[doc] = spans
    return out


BASE = (
    ("assign", r"(?ai)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    ("access", "AKIA[A-Z0-9]+", 0, 20),
    ("hex", "[0-9a-f]+", 0, 24),
)


def base_spans(text):
    found = []
    for k, (name, pattern, group, least) in enumerate(BASE):
        for m in re.finditer(pattern, text or ""):
            if len(m[group]) >= least:
                found.append((m.start(), k, m.end(), name))
    return ",".join(f"{name}:{s}:{e}" for s, _, e, name in sorted(found))


def quality(text):
    w = words(text)
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    covered = set()
    for i, window in enumerate(windows):
        if windows.count(window) > 1:
            covered.update(range(i, i + 5))
    lines = [line for line in (text or "").split("\n") if words(line)]
    return {
        "n_words": len(w),
        "word_chars": sum(map(len, w)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text or "")),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "base_failed": len(w) < 10 or 100 * len(covered) > 20 * len(w),
    }


def common_length(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b, start=1):
            before, row[j] = row[j], before + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def repair(rows):
    """(cost, audit, repaired lines) of (role, text) rows by trying least audits for every state, row by row."""
    seen, turns = set(), []
    for role, text in rows:
        w = words(text)
        gone = not w or (role, text) in seen
        seen.add((role, text))
        turns.append((role, text, gone, not gone and w[-1][-1] not in ".!?"))
    # State: what the kept initials are so far, by the automaton of (s?(ua)+)?
    follow = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    name = {"u": "user", "a": "assistant"}

    def better(table, state, option):
        if state not in table or option < table[state]:
            table[state] = option

    def inserted(table):
        out = {}
        todo = [(s, o) for s, o in table.items()]
        for depth in range(4):
            more = []
            for s, (cost, audit, lines) in todo:
                better(out, s, (cost, audit, lines))
                more += [
                    (follow[s, i], (cost + 2, audit + "I", lines + (name[i] + ":",))) for i in "ua" if (s, i) in follow
                ]
            todo = more
        return out

    table = inserted({"": (0, "", ())})
    for role, text, gone, cut in turns:
        after = {}
        for s, (cost, audit, lines) in table.items():
            better(after, s, (cost + 3, audit + "D", lines))
            if gone:
                continue
            if (s, role[:1]) in follow:
                better(after, follow[s, role[:1]], (cost + cut, audit + "K", lines + (f"{role}:{text}",)))
            for i in "ua":
                if (s, i) in follow:
                    better(after, follow[s, i], (cost + 2 + cut, audit + "R", lines + (f"{name[i]}:{text}",)))
        table = inserted(after)
    return min(table[s] for s in ("", "a") if s in table)


def repair_row(rows):
    """Counts and the repair of (turn, role, text) rows after damage, in any order."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    turns = [t for t, _, _ in rows if t is not None]
    blank = duplicate = truncated = 0
    for i, (_, role, text) in enumerate(rows):
        w = words(text)
        if not w:
            blank += 1
        elif (role, text) in [r[1:] for r in rows[:i]]:
            duplicate += 1
        else:
            truncated += w[-1][-1] not in ".!?"
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    cost, audit, lines = repair([r[1:] for r in rows])
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, blank, duplicate, truncated,
        sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    )


def damage(rows):
    """(conv_id, turn, role, text) rows with faults, and all conversation ids."""
    out = {}
    for conv, turn, role, text in rows:
        said = out.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        act = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if act == 1:
            text = ""
        elif act == 2:
            text = re.sub("[.!?]", "", text)
        elif act == 4:
            role = "user"
        said += [(turn, role, text)] * {0: 0, 3: 2}.get(act, 1)
    return out


def shingle_set(text, size):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = words(low)
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} or ({tuple(w)} if w else set())


def jaccard_classes(rows, size=4, percent=80):
    """(set size, smallest id reachable) per place of (id, text) rows; a null id is larger than all."""
    sets = [shingle_set(t, size) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            common = len(a & b)
            if common and 100 * common >= percent * (len(a) + len(b) - common):
                up[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[root(i)] = min(doc, least.get(root(i), doc))
    return [(len(sets[i]), least.get(root(i))) for i in range(len(rows))]


def one_edit(a, b):
    """Do two different words differ by one inserted, deleted or replaced character?"""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def variants(rows, least=7, times=2, ratio=10):
    """{word: (form, root, n, n_near, form_n)} of (id, text) rows."""
    counts = {}
    for doc, text in rows:
        for run in re.findall("[A-Za-z\u00C0-\u00FF]+", text or ""):
            low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{low}".encode())
            if h % 31 == 0:
                low = low[: h % len(low)] + low[h % len(low) + 1 :]
            counts[low] = counts.get(low, 0) + 1
    counts = {w: n for w, n in counts.items() if len(w) >= least and n >= times}
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best and counts[best] >= ratio * counts[w] else None

    def last(w):
        return last(form[w]) if form[w] else w

    return {w: (form[w], last(w), n, len(near[w]), counts.get(form[w])) for w, n in counts.items()}
