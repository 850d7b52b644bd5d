"""Rows and paths the tests of the training-data operators share."""

SF = "/root/testdata/sf0.001"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lam mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()


def prose(n, seed):
    """n words that don't repeat a run."""
    return " ".join(WORDS[(i * i * 7 + i * seed * 13 + seed * seed * 5 + (i // 24) * 11) % 24] + str((i * 31 + seed * 17) % 97) for i in range(n))


#: (doc_id, text): nulls, empty and blank texts, one word, ties, copies, near copies, shared passages, a very long text
EDGE = [
    (1, None),
    (2, ""),
    (3, " \t\n "),
    (4, "one"),
    (5, "ONE"),
    (6, prose(200, 1)),
    (7, prose(200, 1)),
    (8, prose(197, 1) + " other end here"),
    (9, "start " + prose(200, 2)[:700] + " " + prose(80, 1)),
    (10, "word " * 3000),
    (11, "word " * 120),
    (12, "All rights reserved. ALL RIGHTS RESERVED, cc-by; Licensed under the GNU General Public License, version 3."),
    (13, "mail a.b@c.example.org or +1 (377) 555-0271 from 10.0.0.255 and 300.1.1.1, card 4539 1488 0343 6467, iban GB82 WEST 1234 5698 7654 32"),
    (14, "日本語のテキスト \U0001f600 Привет мир"),
    (15, "12345 67890 !!! ..."),
    (16, prose(6000, 3)),
    (17, "x" * 20000),
    (18, "1 " * 5000 + "a@b." * 300),
    (19, prose(60, 1)[5:]),
    (20, "▁ spaced   out  text \r\n"),
]
