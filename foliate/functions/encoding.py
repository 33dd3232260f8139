"""Bytes of HTML pages to text: byte-order mark, declarations, then UTF-8 and Windows-1252."""

from __future__ import annotations

import codecs
import re

#: Bytes of a page that are searched for a declaration.
PRESCAN = 2048
#: Byte-order marks and what they stand for; longer ones first (fixed values).
MARKS = ((b"\xff\xfe\x00\x00", "utf-32-le"), (b"\x00\x00\xfe\xff", "utf-32-be"), (b"\xef\xbb\xbf", "utf-8"), (b"\xff\xfe", "utf-16-le"), (b"\xfe\xff", "utf-16-be"))
#: Labels that pages use for a superset of what they name (fixed by the encoding standard).
SUPERSETS = {
    "ascii": "cp1252", "iso8859-1": "cp1252", "latin-1": "cp1252", "iso8859-9": "cp1254", "iso8859-11": "cp874", "tis-620": "cp874", "gb2312": "gb18030", "gbk": "gb18030", "euc_kr": "cp949", "shift_jis": "cp932",
    # A page whose declaration can be read byte by byte isn't in these.
    "utf-16": "utf-8", "utf-16-le": "utf-8", "utf-16-be": "utf-8", "utf-32": "utf-8", "utf-32-le": "utf-8", "utf-32-be": "utf-8",
}

_XML = re.compile(rb"""\A\s*<\?xml[^>]*?\sencoding\s*=\s*["']\s*([A-Za-z0-9._:-]+)""")
_TAG = re.compile(rb"""<!--.*?(?:-->|\Z)|<(?P<name>/?[a-zA-Z][^\s/>]*)(?P<attributes>(?:[^>"']|"[^"]*(?:"|\Z)|'[^']*(?:'|\Z))*)""", re.S)
_ATTRIBUTE = re.compile(rb"""([^\s"'=<>/]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_CHARSET = re.compile(rb"""charset\s*=\s*["']?\s*([^\s;"'>]+)""", re.I)


def _c1(error: UnicodeError):
    """Bytes that Windows-1252 leaves open are the control characters of the same number."""
    if not isinstance(error, UnicodeDecodeError):
        raise error
    return "".join(map(chr, error.object[error.start : error.end])), error.end


codecs.register_error("foliate-c1", _c1)


def known(label: bytes) -> str | None:
    """The codec that a declared label stands for, None for an unknown one."""
    try:
        name = codecs.lookup(label.decode("ascii").strip()).name
        name = SUPERSETS.get(name, name)
        b"a".decode(name)  # text codecs only
    except (LookupError, UnicodeError, ValueError):
        return None
    return name


def declared(content: bytes) -> list[str]:
    """Codecs named by the XML declaration and by the first meta element that names one."""
    head, found = content[:PRESCAN], []
    if m := _XML.match(head):
        found.append(known(m[1]))
    for m in _TAG.finditer(head):
        if (m["name"] or b"").lower() != b"meta":
            continue
        values = {a[1].lower(): a[2] or a[3] or a[4] or b"" for a in _ATTRIBUTE.finditer(m["attributes"])}
        label = values.get(b"charset")
        if label is None and values.get(b"http-equiv", b"").strip().lower() == b"content-type" and (c := _CHARSET.search(values.get(b"content", b""))):
            label = c[1]
        if label and (name := known(label)):
            found.append(name)
            break
    return [x for x in found if x]


def decode_html(content: bytes) -> tuple[str, str]:
    """The text of a page and the codec it was read with.

    A byte-order mark decides. Else the first of these reads the page without a fault: UTF-16 where
    its first character is < beside a zero byte, the declared encodings, UTF-8. Everything else is
    Windows-1252, which reads any bytes; so does a byte-order mark's encoding, with U+FFFD for faults.
    """
    for mark, name in MARKS:
        if content.startswith(mark):
            return content[len(mark) :].decode(name, "replace"), name
    wide = ["utf-16-le"] if content[:2] == b"<\0" else ["utf-16-be"] if content[:2] == b"\0<" else []
    for name in [*wide, *declared(content), "utf-8"]:
        try:
            return content.decode(name, "foliate-c1" if name == "cp1252" else "strict"), name
        except (UnicodeDecodeError, UnicodeError):
            continue
    return content.decode("cp1252", "foliate-c1"), "cp1252"
