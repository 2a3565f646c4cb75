"""Plain single-machine versions of the operators, as slow and as simple as possible."""

import collections
import itertools
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans({chr(65 + k): chr(97 + k) for k in range(26)})
PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def quality(text, lengths=(5, 10)):
    words = WORD.findall(text or "")
    grams = collections.Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    twice = {j for i in range(len(words) - 2) if grams[tuple(words[i:i + 3])] > 1 for j in range(i, i + 3)}
    seen, repeated = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            repeated += line in seen
            seen.add(line)
    found = {"n_words": len(words), "word_chars": sum(map(len, words)), "n_dup_lines": repeated,
             "n_symbols": len(re.findall(r"[#*$%&|<>]", text or "")), "n_repeat_words": len(twice)}
    for n in lengths:
        seen, inside = set(), set()
        for i in range(len(words) - n + 1):
            gram = tuple(words[i:i + n])
            if gram in seen:
                inside |= set(range(i, i + n))
            seen.add(gram)
        found[f"dup_{n}gram_chars"] = sum(len(words[i]) for i in inside)
    return found


def shingles(text, n=5):
    words = WORD.findall((text or "").translate(FOLD))
    if len(words) < n:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)}


def near_duplicates(rows):
    """(key, number of shingles, component) of (key, text) rows, over all pairs that share a shingle."""
    sets = [shingles(text) for _, text in rows]
    at = collections.defaultdict(list)
    for k, found in enumerate(sets):
        for gram in found:
            at[gram].append(k)
    common = collections.Counter(p for ks in at.values() for p in itertools.combinations(ks, 2))
    root = list(range(len(rows)))

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    for (i, j), both in common.items():
        if 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
            root[top(i)] = top(j)
    low = {}
    for k, (key, _) in enumerate(rows):
        if key is not None:
            low[top(k)] = min(low.get(top(k), key), key)
    return [(key, len(sets[k]), low.get(top(k)) if sets[k] else key) for k, (key, _) in enumerate(rows)]


def luhn(digits):
    worth = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(digits))]
    return sum(w - 9 if w > 9 else w for w in worth) % 10 == 0


def pii(text):
    found = []
    for kind, pattern in PII.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")),
                  "card": 16 <= len(digits) <= 19 and luhn(digits), "phone": 8 <= len(digits) <= 15}[kind]
            if ok:
                found.append((kind, m.start(), m.end()))
    return found


def url_parts(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    return (m[1].translate(FOLD), m[2]) if m else ("", "")


def url_rule(url, rules):
    host, path = url_parts(url)
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules
            if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[2:] if fits else (None, "allow")


def alignment(item, text, match=2, mismatch=-1, gap=-1):
    above, best = [0] * (len(text) + 1), 0
    for word in item:
        row = [0]
        for j, other in enumerate(text):
            row.append(max(0, above[j] + (match if word == other else mismatch), above[j + 1] + gap, row[j] + gap))
        best, above = max(best, *row), row
    return best


def runs(words, min_length=12):
    """(start, length, period) of every run: equal stretches at every distance, the smallest period of each."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(min_length, 2 * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in found.items())


def phrases(rows, min_count=10, max_words=3, top=2000, cover_percent=50):
    """{language: [(phrase, a, l, r, n, score)]} of (text, language) rows, by counting every phrase."""
    counts, totals = collections.Counter(), collections.Counter()
    for text, lang in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(FOLD)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            counts.update((lang, *words[i:i + k]) for k in range(1, max_words + 1) for i in range(len(words) - k + 1))
    found = collections.defaultdict(list)
    frequent = {g: n for g, n in counts.items() if n >= min_count and len(g) > 2}
    around = collections.Counter()
    for (lang, *words), n in frequent.items():
        for k in range(2, len(words)):
            for i in range(len(words) - k + 1):
                part = (lang, *words[i:i + k])
                around[part] = max(around[part], n)
    for (lang, *words), a in frequent.items():
        if 100 * around[lang, *words] >= cover_percent * a:
            continue
        cuts = [(counts[lang, *words[:k]], counts[lang, *words[k:]], k) for k in range(1, len(words))]
        score, _, l, r = min((10**6 * a * a // (l * r), k, l, r) for l, r, k in cuts)
        found[lang].append((" ".join(words), a, l, r, totals[lang], score))
    return {lang: sorted(own, key=lambda p: (-p[5], -p[1], p[0].encode()))[:top] for lang, own in found.items()}
