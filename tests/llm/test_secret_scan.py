import hashlib
import math
import random
import re
from collections import Counter

from marlstone.llm.secret_scan import EntropyRules, base_spans, entropy_windows, scan_text, secret_scan

from .helpers import awkward, frame

KINDS = ("assign", "access", "hex")


def plain(text):
    """The base patterns as the contract words them."""
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    return sorted(out + [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24])


def test_base_patterns_match_the_plain_reading():
    rng = random.Random(5)
    parts = ["password", "PASSWD", "secret", "Token", "api_key", "apikey", ":", "=", " ", '"', "'", "AKIA", "abcdef", "0123456789", "XYZ", "é", "\n", "+/", "token=abc", "secret=token:abcdefgh", "deadbeef" * 3]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 25)))
        assert sorted(base_spans(text)) == plain(text) == scan_text(text, EntropyRules())[0]


def test_entropy_is_updated_as_if_counted_anew():
    rng = random.Random(2)
    for _ in range(200):
        s = "".join(rng.choice("abcdefgh0123456789XYZ"[: rng.randint(2, 21)]) for _ in range(rng.randint(1, 60)))
        least, w = rng.choice([2.0, 3.0, 3.5]), 12
        hot = set()
        for i in range(len(s) - w + 1):
            counts = Counter(s[i : i + w])
            if -sum(c / w * math.log2(c / w) for c in counts.values()) >= least - 1e-9:
                hot |= set(range(i, i + w))
        assert {j for a, b in entropy_windows(s, w, least) for j in range(a, b)} == hot


def test_entropy_finds_keys_and_leaves_plain_text_alone():
    key = "tF9xQ2mL8vR4kZ7wJ1pB6nH3"
    base, spans = scan_text(f"use {key} now", EntropyRules())
    assert base == [] and spans == [(4, 3, 4 + len(key))]
    for clean in ("antidisestablishmentarianism rules", "see /usr/share/dictionary/words-and-names", "123e4567-e89b-12d3-a456-426614174000", "2024-01-02-03-04-05-06-07", "=" * 40, "ab1" * 30, "1" * 50, "chapter-12/section-3/part-7"):
        assert scan_text(clean, EntropyRules())[1] == base_spans(clean)


def test_entropy_finds_grouped_keys_and_keys_of_letters():
    for key in ("Zk7-q9XwB2mL4pRt-V8sYc3Nd6HgJ", "QxZvKpTrWmLsBnYcDfGhJkRw", "qzvkptrwmlsbnycdfghjkrwxqzvkptaeiou", "use/QxZvKpTrWmLsBnYcDfGhJkRw", "QxZvKpTrWmLsBnYcDfGhJk7"):
        assert any(k == 3 for _, k, _ in scan_text(f"use {key} now", EntropyRules())[1]), key
    assert scan_text("use QxZvKpTrWmLsBnYcDfGhJkRw now", EntropyRules(digit_and_letter=True))[1] == []
    for clean in ("getUserNameFromRequestHeader", "Donaudampfschifffahrtskapitaen", "2024-01-02T101112Z-report-final", "https/example/api/v2/user-accounts/part7", "utm_source=newsletter_campaign", "==Quarterly_planning_world=="):
        assert scan_text(f"use {clean} now", EntropyRules())[1] == [], clean


def test_rows(spark):
    rows = awkward() + [(910, None, "", "", 0), (911, "é secret = abcdef0 " + "x " * 30_000 + "token:'zzzzzz'", "", "", 1)]
    got = secret_scan(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    want = sorted((str(r[0]), hashlib.sha256(",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in plain(r[1] or "")).encode()).hexdigest()) for r in rows)
    assert sorted((str(r.doc_id), r.base_sha256) for r in got) == want
    assert {r.doc_id: r.n_assign for r in got}[911] == 2
    assert secret_scan(frame(spark, [])).count() == 0
    big = [(9007199254740993, "x", "", "", 0), (None, "y", "", "", 0)]
    assert {r.doc_id for r in secret_scan(frame(spark, big)).collect()} == {9007199254740993, None}


def test_one_candidate_of_megabytes():
    rng = random.Random(1)
    text = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz0123456789", k=2_000_000))
    assert sum(b - a for a, k, b in scan_text(text, EntropyRules())[1] if k == 3) > 0.99 * len(text)
    assert scan_text("g" * 2_000_000, EntropyRules())[1] == []
