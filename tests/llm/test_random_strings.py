"""Random strings of letters alone, and behind words."""

from __future__ import annotations

import random
import string

from loomgraph.llm import secrets


def test_secrets_of_letters_and_behind_words():
    bpe, rng = secrets.encoder(secrets.VOCABULARY), random.Random(11)
    found = lambda text: [text[a:b] for a, b, _ in secrets.random_spans(text, bpe)]
    keys = ["".join(rng.choices(string.ascii_letters, k=24)) for _ in range(50)]
    assert sum(found(f"key {k} end") == [k] for k in keys) >= 48
    behind = 0
    for _ in range(50):
        key = "".join(rng.choices(string.ascii_letters + string.digits, k=20))
        behind += any(s.endswith(key) for s in found(f"see com/users/account/settings/{key} end"))
    assert behind >= 45
    for plain in ("internationalization", "getUserAccountSettings", "com/users/account/settings/profile", "SOME_LONG_CONSTANT_NAME", "-" * 40, "1234567890123456789"):
        assert found(plain) == []
    assert not secrets.known_form("a" * 5000 + "Ab")
