"""Raw files for the tests."""

import os


def write_bytes(path, data: bytes):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data)
    return str(path)


def write_text(path, text: str):
    return write_bytes(path, text.encode("utf-8"))
