"""URLs as the living standard of the web parses them: absolute ones, without a base."""

from __future__ import annotations

import ipaddress
import re
from urllib.parse import unquote_to_bytes

#: Schemes with an authority and their usual ports.
SPECIAL = {"http": 80, "https": 443, "ws": 80, "wss": 443, "ftp": 21, "file": None}
#: What a path escapes besides controls and all but ASCII, and what no host may hold.
PATH_ESCAPES = set(' "#<>?^`{}')
FORBIDDEN_HOST = set("\0\t\n\r #/:<>?@[\\]^|")
_SCHEME = re.compile(r"([A-Za-z][A-Za-z0-9+.\-]*):(.*)", re.DOTALL)
_ENDS = "".join(map(chr, range(0x21)))


class NotAUrl(ValueError):
    pass


def _escaped(text: str, escapes: set[str]) -> str:
    return "".join(c if 0x20 <= ord(c) < 0x7F and c not in escapes else "".join(f"%{b:02X}" for b in c.encode("utf-8", "surrogatepass")) for c in text)


def _number(part: str) -> int | None:
    """A part of an IPv4 address in decimal, octal (0) or hexadecimal (0x)."""
    if not part:
        return None
    base, digits = (16, part[2:]) if part[:2].lower() == "0x" else (8, part[1:]) if len(part) > 1 and part[0] == "0" else (10, part)
    try:
        return int(digits or "0", base) if re.fullmatch("[0-9A-Fa-f]*", digits) else None
    except ValueError:
        return None


def _ipv4(host: str) -> str | None:
    """The address, or None for a host that is none; a host that ends in a number must be one."""
    parts = host.split(".")
    if parts[-1] == "" and len(parts) > 1:
        parts.pop()
    if not (parts[-1].isdigit() and parts[-1].isascii()) and _number(parts[-1]) is None:
        return None
    numbers = [_number(p) for p in parts]
    if len(parts) > 4 or None in numbers or any(n > 255 for n in numbers[:-1]) or numbers[-1] >= 256 ** (5 - len(numbers)):
        raise NotAUrl(host)
    value = numbers[-1] + sum(n << 8 * (3 - i) for i, n in enumerate(numbers[:-1]))
    return ".".join(str(value >> s & 255) for s in (24, 16, 8, 0))


def _host(text: str, special: bool) -> str:
    if text.startswith("["):
        if not text.endswith("]"):
            raise NotAUrl(text)
        try:
            address = ipaddress.IPv6Address(text[1:-1])
        except ValueError as error:
            raise NotAUrl(text) from error
        if "%" in text:
            raise NotAUrl(text)
        mapped = re.fullmatch(r"(.*:)(\d+)\.(\d+)\.(\d+)\.(\d+)", str(address))  # pieces stay hexadecimal
        if mapped:
            a, b, c, d = (int(x) for x in mapped.groups()[1:])
            return f"[{mapped[1]}{a << 8 | b:x}:{c << 8 | d:x}]"
        return f"[{address}]"
    if not special:
        if FORBIDDEN_HOST & set(text):
            raise NotAUrl(text)
        return _escaped(text, set())
    try:
        domain = unquote_to_bytes(text).decode("utf-8", "replace").lower()
        if not domain.isascii():
            domain = ".".join(p.encode("idna").decode() if not p.isascii() else p for p in re.split("[.。．｡]", domain))
    except UnicodeError as error:
        raise NotAUrl(text) from error
    if not domain or any(c in FORBIDDEN_HOST or c == "%" or ord(c) < 0x20 or ord(c) == 0x7F for c in domain):
        raise NotAUrl(text)
    return _ipv4(domain) or domain


def _authority(text: str, scheme: str) -> str:
    """host, and port unless it is the usual one."""
    special = scheme in SPECIAL
    rest = text.rpartition("@")[2]
    match = re.fullmatch(r"(\[[^\]]*\]|[^:]*)(?::(.*))?", rest, re.DOTALL)
    if match is None or (special and not match[1]) or (not match[1] and (match[2] is not None or "@" in text)):
        raise NotAUrl(text)
    port = match[2] or ""
    if port and not (port.isascii() and port.isdigit() and int(port) < 65536):
        raise NotAUrl(text)
    usual = not port or SPECIAL.get(scheme) == int(port)
    return _host(match[1], special) + ("" if usual else f":{int(port)}")


def _path(text: str, special: bool) -> str:
    """An absolute path without dot segments."""
    out: list[str] = []
    segments = re.split(r"[/\\]" if special else "/", text)
    for i, segment in enumerate(segments):
        last, dots = i == len(segments) - 1, segment.lower().replace("%2e", ".")
        if dots == "..":
            if out:
                out.pop()
            if last:
                out.append("")
        elif dots == ".":
            if last:
                out.append("")
        else:
            out.append(_escaped(segment, PATH_ESCAPES))
    return "/" + "/".join(out)


def parse(text: str) -> tuple[str, str, str]:
    """(scheme, host with port, path); NotAUrl for what is no absolute URL."""
    text = re.sub("[\t\n\r]", "", text.strip(_ENDS))
    match = _SCHEME.match(text)
    if not match:
        raise NotAUrl(text)
    scheme, rest = match[1].lower(), re.split("[?#]", match[2], maxsplit=1)[0]
    if scheme == "file":
        rest = rest.replace("\\", "/")
        host, path = (rest[2:].partition("/")[::2]) if rest.startswith("//") else ("", rest.removeprefix("/"))
        if re.fullmatch("[A-Za-z][:|]", host):  # a drive is part of the path
            host, path = "", f"{host}/{path}"
        host = _host(host, True) if host else ""
        path = re.sub(r"^/*([A-Za-z])\|(?=/|$)", r"\1:", path)
        return scheme, "" if host == "localhost" else host, _path(path, True)
    if scheme in SPECIAL:
        rest = rest.lstrip("/\\")
        cut = re.search(r"[/\\]", rest)
        authority, path = (rest[: cut.start()], rest[cut.start() + 1 :]) if cut else (rest, "")
        return scheme, _authority(authority, scheme), _path(path, True)
    if rest.startswith("//"):
        authority, slash, path = rest[2:].partition("/")
        return scheme, _authority(authority, scheme) if authority else "", _path(path, False) if slash else ""
    if rest.startswith("/"):
        return scheme, "", _path(rest[1:], False)
    return scheme, "", _escaped(rest, set()).rstrip(" ") if rest == match[2] else _escaped(rest, set())


def canonical(text: str) -> str | None:
    """scheme://host/path without trailing slashes, query and fragment."""
    try:
        scheme, host, path = parse(text)
    except NotAUrl:
        return None
    return f"{scheme}://{host}{path.rstrip('/')}"
