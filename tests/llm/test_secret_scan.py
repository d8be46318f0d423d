from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from metaingest.llm import secret_scan as secrets
from metaingest.llm import words as w
from metaingest.llm.automaton import compile_rules

BASE = {
    "assign": re.compile(
        r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
        r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
    ),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "hex": re.compile(r"[0-9a-f]+"),
}


def plain(text: str) -> list[tuple[str, int, int]]:
    out = []
    for order, (kind, rule) in enumerate(BASE.items()):
        for m in rule.finditer(text):
            size = len(m.group(2)) if kind == "assign" else len(m.group())
            if size >= {"assign": 6, "access": 20, "hex": 24}[kind]:
                out.append((m.start(), order, (kind, m.start(), m.end())))
    return [x[2] for x in sorted(out)]


def scanned(texts: list[str | None]) -> list[list[tuple[str, int, int]]]:
    out = [[] for _ in texts]
    for row, data, spans in secrets._scan(pa.array(texts, pa.string()), secrets.RULES):
        points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
        out[row] = [(secrets.RULES[k].kind, int(points[a]), int(points[b])) for k, a, b in spans]
    return out


def base(spans):
    return [s for s in spans if s[0] in BASE]


pieces = st.sampled_from(
    ["password", "PassWd", "secret", "token", "api_key", "APIKEY", "AKIA", "AKI", "=", ":", " ", '"', "'", "abcdef", "0123456789abcdef", "A1B2C3D4E5", "é", "-", "\n", "x", "==", "f" * 23]
)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(pieces, max_size=14).map("".join), min_size=1, max_size=6))
def test_base_spans_are_those_of_the_regexes(texts):
    assert [base(s) for s in scanned(texts)] == [plain(t) for t in texts]


@pytest.mark.parametrize("before", [0, 1, 2040, 2047, 2048, 4090])
def test_blocks_do_not_matter(before):
    texts = ["x" * before + "token: abcdefgh" + "0" * 5000 + " AKIA" + "Z" * 3000, None, "", "a" * 23, "a" * 24]
    assert [base(s) for s in scanned(texts)] == [plain(t or "") for t in texts]


def test_a_short_match_still_takes_its_text():
    assert scanned(["secret: token: abcdefgh"]) == [[]]


def test_other_kinds():
    texts = ["-----BEGIN RSA PRIVATE KEY-----", "ghp_" + "a1B" * 12, "xoxb-1234567890-abcdef"]
    assert [{s[0] for s in spans} - set(BASE) for spans in scanned(texts)] == [{"private_key"}, {"code_host"}, {"chat_bot"}]


def _masked(text: str) -> str:
    [(_, data, spans)] = secrets._scan(pa.array([text]), secrets.RULES)
    return secrets._masked(data, spans, "#")


@pytest.mark.parametrize("line_end", ["\n", "\r\n", "\\n", '\\n"\n"', "\n> "])
@pytest.mark.parametrize("fields", [[], ["Proc-Type: 4,ENCRYPTED", "DEK-Info: AES-128-CBC,0123ABCD", ""]])
def test_private_keys_go_with_their_body(line_end, fields):
    begin, end = "-----BEGIN RSA PRIVATE KEY-----", "-----END RSA PRIVATE KEY-----"
    body = ["MIIEpAIBAAKCAQEA" + "aB3/" * 11 + "x+Zq", *["Zz9+" * 16] * 30, "q0=="]
    whole, cut = line_end.join([begin, *fields, *body, end]), line_end.join([begin, *fields, *body])
    assert _masked(f"é {whole} between {whole}{line_end}after") == f"é # between #{line_end}after"
    assert _masked(f"é {cut}") == "é #"
    assert _masked(f"{cut}\n{whole}.") == "#\n#."


def test_a_private_key_header_alone():
    begin = "-----BEGIN PRIVATE KEY-----"
    assert _masked(f"a {begin} is how such files begin. {begin}é{begin}") == "a # is how such files begin. #é#"
    assert _masked(begin + "\nshort words only\n-----END CERTIFICATE-----") == "#\nshort words only\n-----END CERTIFICATE-----"
    assert _masked(f"{begin}\nA-b--c---d----\n-----END PRIVATE KEY-----x") == "#x"


def test_automaton_is_minimal():
    # four states for (a|b)*abb, and one that other bytes lead to
    assert len(compile_rules(["(a|b)*abb"], anywhere=False).step) == 5


def test_redact(spark):
    rows = [(1, "é token=abcdefgh;", 18, 7), (2, None, None, 7), (3, "clean", 5, 7), (3, "clean", 5, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, spans int")
    out = sorted(map(tuple, secrets.redact(docs).collect()))
    assert out == [(1, "é [REDACTED];", 13, 7), (2, None, None, 7), (3, "clean", 5, 7), (3, "clean", 5, 7)]


def test_no_documents(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert secrets.find_secrets(docs).collect() == [] and secrets.redact(docs).collect() == []
