"""Key files as they stand in JSON, YAML and source strings, and encrypted ones."""

from __future__ import annotations

import base64
import json

import pytest

from framestore.llm.secrets import redacted, secret_spans
from test_operators import KEY

BODY = base64.encodebytes(KEY).decode()
PEM = f"-----BEGIN PRIVATE KEY-----\n{BODY}-----END PRIVATE KEY-----\n"
HEADERS = "Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,0123456789ABCDEF0123456789ABCDEF\n\n"
SEALED = base64.encodebytes(bytes(range(1, 129))).decode()
ENCRYPTED = f"-----BEGIN RSA PRIVATE KEY-----\n{HEADERS}{SEALED}-----END RSA PRIVATE KEY-----\n"


def pems(text):
    return [text[a:b] for a, b, kind in secret_spans(text) if kind == "pem"]


@pytest.mark.parametrize("key", [PEM, ENCRYPTED, PEM.replace("\n", "\r\n"), ENCRYPTED.replace("\n", "\r\n")])
def test_key_files_in_strings(key):
    source = " +\n    ".join(json.dumps(line + "\n") for line in key.splitlines())
    forms = [
        key, json.dumps({"private_key": key}), json.dumps(json.dumps({"private_key": key})), json.dumps(key).replace("/", "\\/"),
        json.dumps(key).replace("=", "\\u003d"), "key: |\n  " + key.replace("\n", "\n  "), f"String key = {source};", source.replace(" +\n", "\n"),
    ]
    for text in forms:
        found = pems(f"a {text} b")
        assert len(found) == 1 and found[0].startswith("-----BEGIN") and found[0].endswith("KEY-----")
        clean = redacted(text, secret_spans(text), "[SECRET]")
        assert BODY[:20] not in clean and SEALED[:20] not in clean


def test_what_is_no_key_file():
    assert not pems(json.dumps(PEM.replace(BODY[:8], "AAAAAAAA"))) and not pems(ENCRYPTED.replace("DEK-Info", "DEK-Other"))
    assert not pems(ENCRYPTED.replace(SEALED, "")) and not pems(ENCRYPTED.replace(",0123456789ABCDEF", ",x"))
    assert pems("-----BEGIN PRIVATE KEY-----\n" * 3 + "see -- below\n" + PEM) == [PEM.strip()]
