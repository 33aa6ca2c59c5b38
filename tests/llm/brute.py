"""Plain Python versions of the queries' contracts, row by row."""
import base64
import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import tiktoken


def sha(x):
    return hashlib.sha256(x.encode() if isinstance(x, str) else x).hexdigest()


def encoding():
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def op1(text, enc):
    ids = enc.encode_ordinary(text or "")
    return len(ids), sha(np.array(ids, "<u4").tobytes()), sha(text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words2(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower(text))


def op2(text, items, n=10):
    w, hit, found = words2(text), set(), set()
    for item, t in items:
        iw = words2(t)
        size = min(n, len(iw))
        for k in range(len(iw) - size + 1 if iw else 0):
            for j in range(len(w) - size + 1):
                if w[j:j + size] == iw[k:k + size]:
                    hit.update(range(j, j + size))
                    found.add(str(item))
    return len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)


def luhn(s):
    return sum(int(x) if i % 2 == 0 else sum(divmod(int(x) * 2, 10)) for i, x in enumerate(reversed(s))) % 10 == 0


def digits(s):
    return re.sub("[^0-9]", "", s)


def op6(t):
    t = t or ""
    out = [(m.start(), 0, m.end(), "email") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), 1, m.end(), "ip") for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [(m.start(), 2, m.end(), "card") for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 14 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    out += [(m.start(), 3, m.end(), "phone") for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 10 <= len(digits(m[0])) <= 15]
    return [f"{k}:{a}:{b}" for a, _, b, k in sorted(out)]


def op8(t):
    t = t or ""
    out = [(m.start(), 0, m.end(), "assign") for m in re.finditer(
        r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 24]
    return [f"{k}:{a}:{b}" for a, _, b, k in sorted(out)]


def classes(ids, linked):
    """Least id reachable, by plain search."""
    out = {}
    for i in sorted(set(ids)):
        if i in out:
            continue
        todo = [i]
        while todo:
            x = todo.pop()
            if x not in out:
                out[x] = i
                todo += [y for y in linked.get(x, ()) if y not in out]
    return out


def shingles(text, k):
    w = re.findall("[^\x20\x09-\x0d]+", lower(text))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def op10(docs, k, percent):
    sets = {i: shingles(t, k) for i, t in docs}
    linked = {}
    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                linked.setdefault(a, []).append(b)
                linked.setdefault(b, []).append(a)
    c = classes(sets, linked)
    return {i: (len(sets[i]), c[i]) for i in sets}


def op4(rows, threshold=0.95):
    ok = {}
    for i, v in rows:
        if v and None not in v and np.isfinite(v).all() and any(v):
            ok[i] = np.array(v, float)
    linked = {}
    for a in ok:
        for b in ok:
            if a != b and len(ok[a]) == len(ok[b]) and ok[a] @ ok[b] / (np.linalg.norm(ok[a]) * np.linalg.norm(ok[b])) >= threshold:
                linked.setdefault(a, []).append(b)
    c = classes([i for i, _ in rows], linked)
    return {i: (len(linked.get(i, ())), c[i]) for i, _ in rows}


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def op5(docs, k=1, least=20):
    """{doc_id: (removed positions, text)}; ids are unique here."""
    places = {}
    for i, t in docs:
        for p, line in enumerate((t or "").split("\n") if t is not None else []):
            line = line.strip(" ")
            if len(line) >= least:
                places.setdefault(line, []).append((i, p))
    lines = sorted(places)
    linked = {}
    for x in range(len(lines)):
        for y in range(x):
            if abs(len(lines[x]) - len(lines[y])) <= k and distance(lines[x], lines[y]) <= k:
                linked.setdefault(x, []).append(y)
                linked.setdefault(y, []).append(x)
    c = classes(range(len(lines)), linked)
    head = {}
    for x, line in enumerate(lines):
        head[c[x]] = min([head.get(c[x], min(places[line])), min(places[line])])
    gone = {p for x, line in enumerate(lines) for p in places[line] if p != head[c[x]]}
    out = {}
    for i, t in docs:
        removed = sorted(p for d, p in gone if d == i)
        out[i] = (removed, t if not removed else "\n".join(s for p, s in enumerate(t.split("\n")) if p not in removed))
    return out


def op11(rows):
    """Rows (conv_id, turn, role, text) -> {conv_id: (gaps, blank, duplicate, truncated, illegal, cost, audit, sha256)}."""
    one = lambda v: " " if v is None else str(v)
    after = {r[0]: [] for r in rows}
    for conv, turn, role, text in rows:
        case = zlib.crc32(f"{one(conv)}:{one(turn)}".encode()) % 20
        role, text = one(role), one(text)
        if case == 0:
            continue
        text = "" if case == 1 else re.sub("[.!?]", "", text) if case == 2 else text
        role = "user" if case == 4 else role
        after[conv] += [(turn, role, text)] * (2 if case == 3 else 1)
    out = {}
    for conv, found in after.items():
        found.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        faults, seen = [], set()
        for _, role, text in found:
            bare = re.sub("[\x20\x09-\x0D]+$", "", text)
            faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = [r[0] for r in found if r[0] is not None]
        illegal = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in zip(found, found[1:]))
        best = _cheapest_edits([(r[1], r[2], f) for r, f in zip(found, faults)])
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("blank"), faults.count("duplicate"),
                     faults.count("truncated"), illegal, best[0], best[1], hashlib.sha256("\n".join(best[2]).encode()).hexdigest())
    return out


def _cheapest_edits(rows):
    """Layer by layer: the least (cost, audit) that leaves each legal beginning, written as a state of the pattern."""
    def after(state, initial):
        return {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}.get((state, initial))

    def better(table, state, label):
        if state not in table or label[:2] < table[state][:2]:
            table[state] = label

    def inserted(table):
        for _ in range(4):
            for state, (cost, audit, kept) in list(table.items()):
                for role in ("user", "assistant"):
                    if after(state, role[0]):
                        better(table, after(state, role[0]), (cost + 5, audit + "I", kept + [role + ":"]))
        return table

    table = inserted({"": (0, "", [])})
    for role, text, fault in rows:
        nxt = {}
        for state, (cost, audit, kept) in table.items():
            better(nxt, state, (cost + 2, audit + "D", kept))
            if fault not in ("blank", "duplicate"):
                more = 5 if fault else 0
                for edit, new in (("K", role), ("R", "user"), ("R", "assistant")):
                    if after(state, new[:1]):
                        better(nxt, after(state, new[:1]), (cost + more + (edit == "R"), audit + edit, kept + [f"{new}:{text}"]))
        table = inserted(nxt)
    return min(table[s] for s in ("", "a") if s in table)


def op12(docs):
    """(doc_id, text) rows -> {word: (form, root, n, n_near, form_n)}."""
    n = {}
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] = n.get(run, 0) + 1
    n = {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}

    def near(a, b):
        if abs(len(a) - len(b)) > 1 or a == b:
            return False
        k = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        return a[k + 1:] == b[k + 1:] if len(a) == len(b) else a[k + 1:] == b[k:] if len(a) > len(b) else a[k:] == b[k + 1:]

    words = sorted(n)
    by_size = {}
    for w in words:
        by_size.setdefault(len(w), []).append(w)
    others = {w: [v for size in (-1, 0, 1) for v in by_size.get(len(w) + size, ()) if near(w, v)] for w in words}
    form = {}
    for w in words:
        best = min(others[w], key=lambda v: (-n[v], v.encode()), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    out = {}
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n[w], len(others[w]), n.get(form[w]))
    return out


def op13(docs, window=13):
    """(doc_id, text) rows -> [(doc_id, n_words, n_removed, sha256)], row by row."""
    words = [(doc, re.findall("[^\x20\x09-\x0D]+", text or "")) for doc, text in docs]
    least = {}
    for doc, w in words:
        for k in range(len(w) - window + 1):
            if doc is not None:
                g = tuple(w[k:k + window])
                least[g] = min(least.get(g, doc), doc)
    out = []
    for doc, w in words:
        gone = {p for k in range(len(w) - window + 1) if doc is not None and least[tuple(w[k:k + window])] < doc for p in range(k, k + window)}
        kept = " ".join(x for p, x in enumerate(w) if p not in gone)
        out.append((doc, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out
