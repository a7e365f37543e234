"""Small documents with every odd case, and plain Python versions of what the
operators compute."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import xxhash

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars int, "
          "score double, start long, row long, term string, fp string, kept boolean, host string, __x int")
SPACE = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TOXIC = ["idiot", "moron", "scum", "clown", "trash"]


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def crc(doc_id, k):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % k


def _words(rnd, n):
    vocabulary = ["the", "of", "and", "ing", "tion", "éau", "über", "señor", "zur", "lich", "que", "les",
                  "mit", "version", "under", "to", "a", "in"]
    return [rnd.choice(vocabulary) if rnd.random() < 0.4 else
            "".join(rnd.choice(["ka", "lo", "mi", "ne", "ru", "sé", "to", "vu"]) for _ in range(rnd.randint(2, 4)))
            for _ in range(n)]


BENCHMARK = [(k, " ".join(_words(random.Random(1000 + k), 14 + k)) + ".") for k in range(6)] + [
    (6, "Short Item here"), (7, ""), (8, None), (None, "no id at all"), (9, "solo")]


def rows(seed=7, n=60):
    """(doc_id, text, source): prose, copies, near copies, secrets, licences,
    benchmark passages, junk, and the odd cases at the end."""
    rnd = random.Random(seed)
    out = []
    for k in range(n):
        t = " ".join(_words(rnd, rnd.randint(15, 120))).capitalize() + "."
        if k % 9 == 4:
            t += "\nLicensed under the Apache License, Version 2.0."
        if k % 11 == 5:
            t += f' token = "{hashlib.sha1(str(k).encode()).hexdigest()}" and AKIA{"Q7" * 8}'
        if k % 10 == 6:
            t = t[:40] + " " + BENCHMARK[k % 6][1].upper().replace(".", "!") + " " + t[40:]
        if k % 13 == 7:
            t = re.sub(" ", "### ", t)
        if k % 8 == 3:
            t += " " + " ".join(rnd.sample(TOXIC, 3))
        out.append((k, t, f"src{k % 3}"))
    for k in range(6):                          # copies and near copies
        t = out[k * 5][1]
        out.append((n + 2 * k, t, "src0"))
        out.append((n + 2 * k + 1, t.replace("the", "The").replace("  ", " "), "src1"))
    line = "the same line again and again\n"
    out.append((190, "A passage of an item with NO id at all, in " + " ".join(_words(rnd, 30)), "src1"))
    out += [(200, None, "src0"), (201, "", "src0"), (202, " \t\n ", None), (203, line * 6, "src1"),
            (204, "solo", "src2"), (205, " ".join(_words(rnd, 30_000)), "src2"), (None, "a text without an id " * 3, "src2"),
            (206, "Söhne\x00 ünd\x1cTöchter \U0001F600 passwd: abc secret=x token: token: abcdefgh api_key='Zz9/zz99'", "src1"),
            (207, "twice the same row " + " ".join(_words(rnd, 20)), "src1")]
    out.append(out[-1])
    return out


def docs(spark, data=None):
    data = rows() if data is None else data
    return spark.createDataFrame(
        [(i, t, "en", s, None if t is None else len(t), 9.5, 1, 2, "x", "y", None, "h", 3) for i, t, s in data], SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def benchmark(spark):
    return spark.createDataFrame([(i, t, 1) for i, t in BENCHMARK], "item_id long, text string, n_words int")


# --- what the operators compute, plainly ------------------------------------

def fingerprint(text):
    w = lower(text).encode().split()
    shingles = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([b" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum((2 * sum(x >> b & 1 for x in h) > len(h)) << b for b in range(64))


def components(ids_prints, bits=2):
    """{fingerprint: smallest doc_id reachable} by comparing all pairs."""
    prints = sorted({p for _, p in ids_prints})
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for i, a in enumerate(prints):
        for b in prints[i + 1:]:
            if (a ^ b).bit_count() <= bits:
                root[find(b)] = find(a)
    least = {}
    for i, p in ids_prints:
        r = find(p)
        if i is not None and (r not in least or i < least[r]):
            least[r] = i
    return {p: least.get(find(p)) for p in prints}, {p: find(p) for p in prints}


def measures(text):
    w = SPACE.findall(text or "")
    times = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    covered = {j for i in range(len(w) - 4) if times[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if SPACE.search(x)]
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(c in "#*$%&|<>" for c in text or ""),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered), "n_lines": len(lines)}


def verdicts(data):
    """(base_failed, kept) per row: the rules, host rates and the beta prior."""
    ms = [measures(t) for _, t, _ in data]
    base = [m["n_words"] < 10 or 100 * m["n_repeat_words"] > 20 * m["n_words"] for m in ms]
    soft = [m["n_symbols"] > max(m["n_words"], 1) * 0.1 or m["n_dup_lines"] > max(m["n_lines"], 1) * 0.5
            or not 2 <= m["word_chars"] / max(m["n_words"], 1) <= 15 for m in ms]
    hosts = defaultdict(lambda: [0, 0])
    for (_, _, s), b, f in zip(data, base, soft, strict=True):
        hosts[s][0] += 1
        hosts[s][1] += b or f
    n, f, k = sum(h[0] for h in hosts.values()), sum(h[1] for h in hosts.values()), len(hosts)
    mean = f / n if n else 0
    rate = {s: mean for s in hosts}
    if k > 1 and 0 < mean < 1:
        between = sum(h[1] ** 2 / h[0] for h in hosts.values()) - n * mean ** 2 - (k - 1) * mean * (1 - mean)
        variance = between / (n - sum(h[0] ** 2 for h in hosts.values()) / n)
        if variance > 0:
            strength = max(0.0, mean * (1 - mean) / variance - 1)
            rate = {s: (h[1] + mean * strength) / (h[0] + strength) for s, h in hosts.items()}
    return [(b, not b and rate[s] <= 0.5 and (rate[s] <= 0.02 or not q))
            for (_, _, s), b, q in zip(data, base, soft, strict=True)]


def windows(items, size=10):
    out = defaultdict(set)
    for i, t in items:
        w = ALNUM.findall(lower(t))
        if w:
            for s in range(max(1, len(w) - size + 1)):
                out[tuple(w[s:s + size])] |= set() if i is None else {str(i)}
    return out


def contamination(text, known):
    w = ALNUM.findall(lower(text))
    hit, items = set(), set()
    for n in {len(k) for k in known}:
        for s in range(len(w) - n + 1):
            found = known.get(tuple(w[s:s + n]))
            if found is not None:
                hit.update(range(s, s + n))
                items |= found
    return len(w), len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), bool(hit)


BASE = [("assign", re.compile(r"""((?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                              re.I | re.A), 2, 6),
        ("access", re.compile("AKIA[A-Z0-9]+"), 0, 20), ("hex", re.compile("[0-9a-f]+"), 0, 24)]


def secrets(text):
    found = [(m.start(), i, m.end(), kind) for i, (kind, rx, group, least) in enumerate(BASE)
             for m in rx.finditer(text or "") if len(m.group(group)) >= least]
    return sorted(found)


def redacted(text, spans, mask="[secret]"):
    if not spans:
        return text
    out, at = "", 0
    for start, end in sorted(spans):
        if start >= at:
            out += text[at:start] + mask
        at = max(at, end)
    return out + text[at:]
