"""Small awkward inputs."""

from __future__ import annotations

import random

COLUMNS = (
    "doc_id long, text string, lang string, source string, n_chars long, hash string, key string, "
    "part string, class string, label string, size string, digest string, id string, size_ string, "
    "t string, w string, row string, anchors string, text_sha256 string, bucket string, words string"
)


def prose(seed, n, letters="abcdefgh"):
    pick = random.Random(seed)
    return " ".join(
        "".join(pick.choice(letters) for _ in range(pick.randrange(2, 7))) for _ in range(n)
    )


def awkward_rows():
    """(doc_id, text, source): nulls, empties, repetitions, shared passages, one long text."""
    base, other, long = prose(1, 120), prose(2, 90), prose(3, 6000)
    passage = prose(4, 40)
    near = base.split()
    near[60] = "changed"
    return [
        (1, base, "b"),
        (2, base, "a"),
        (2, base, "a"),
        (3, base.upper(), "b"),
        (4, " ".join(near), None),
        (5, other + "\n" + passage, "b"),
        (6, passage + "\t " + prose(5, 50), "c"),
        (7, prose(6, 30) + "  " + passage + " end", "c"),
        (7, prose(7, 25), "d"),
        (8, None, "a"),
        (9, "", "a"),
        (10, " \t\n ", None),
        (11, "one two three", "a"),
        (12, "one two  three", "a"),
        (None, other, "b"),
        (None, base, None),
        (13, "be " * 400, "e"),
        (14, long, "f"),
        (15, long[:20000] + " tail " + prose(8, 20), "f"),
        (16, "ñandú élève " * 40 + passage, "g"),
        (17, "x" * 450, "g"),
        (18, "y" * 150 + prose(9, 30), "g"),
    ]
