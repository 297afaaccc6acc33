"""What the detector looks for, by class."""

from __future__ import annotations

import re
from collections.abc import Collection
from dataclasses import dataclass

# Class names and their tokens. "re:" marks a pattern, anything else is literal text.
CLASSES: dict[str, list[str]] = {
    "sql": ["'", '"', ";", "--", "/*", r"re:(?i)UNION\s+SELECT", r"re:(?i)OR\s+1\s*=\s*1"],
    "shell": ["`", "$(", "|", "&&", ";", r"re:(?i)\bcurl\b", r"re:(?i)\bwget\b", r"re:(?i)bash\s+-c", "re:(?i)powershell", r"re:(?i)nc\s+-e", "re:(?i)Invoke-Expression"],
    "html_js": [
        "re:(?i)<script",
        "re:(?i)javascript:",
        "re:(?i)data:text/html",
        r"re:(?i)onerror\s*=",
        r"re:(?i)onload\s*=",
        r"re:(?i)onclick\s*=",
        "re:(?i)<iframe",
        "re:(?i)<svg",
        "re:(?i)<img",
        r"re:(?i)srcdoc\s*=",
        "re:(?i)<object",
        "re:(?i)<embed",
    ],
    "spreadsheet_formula": [r"re:^[=+\-@\t\r]", r"re:(?i)=cmd\|", r"re:(?i)=HYPERLINK\(", r"re:(?i)=DDE\("],
    "template": ["{{", "}}", "${", "<%", "#{", "@{"],
    "jndi": [r"re:(?i)\$\{jndi:", r"re:(?i)\$\{env:", r"re:(?i)\$\{lower:", "${::-"],
    "path_traversal": ["../", "..\\", "re:(?i)%2e%2e", "....//", "/etc/", r"re:(?i)C:\\"],
    "url_ssrf": [
        r"re:(?i)\bhttps?://",
        r"re:(?i)\bfile://",
        r"re:(?i)\bgopher://",
        r"re:(?i)\bldap://",
        r"re:(?i)\bdict://",
        "127.0.0.1",
        r"re:\b10\.\d",
        "192.168.",
        r"re:\b172\.(1[6-9]|2\d|3[01])\.",
        "169.254.169.254",
    ],
    "deserialization": ["rO0AB", "re:(?i)aced0005", 'O:8:"', "AAEAAAD/////", "!!python/object", "!!ruby/object"],
    "xml": ["re:(?i)<!ENTITY", "re:(?i)<!DOCTYPE", r're:(?i)SYSTEM\s+"file://'],
    "ldap": [")(&", "*)(uid="],
    "nosql": ["$where", "$ne", "$regex"],
    "prompt_injection": [r"re:(?i)ignore\s+previous\s+instructions", r"re:(?i)^\s*system:", r"re:(?i)^\s*assistant:"],
    "unicode_trickery": ["re:[\u202a-\u202e\u2066-\u2069\u200b-\u200d\ufeff]"],
    "ioc_canary": [],
}
# Fixed values, as above.
SECRETS: dict[str, list[str]] = {
    "secret_jwt": [r"re:eyJ[A-Za-z0-9_-]{5,}\.[A-Za-z0-9_-]{5,}\.[A-Za-z0-9_-]*"],
    "secret_private_key": ["re:-----BEGIN [A-Z ]*PRIVATE KEY-----", "BEGIN OPENSSH PRIVATE KEY"],
    "secret_cloud": [r"re:\bAKIA[0-9A-Z]{16}\b", r"re:\bASIA[0-9A-Z]{16}\b", '"private_key"', '"client_email"', r"re:\bAIza[0-9A-Za-z_-]{35}\b", "re:(?i)AccountKey=", "re:(?i)SharedAccessSignature"],
    "secret_vendor_token": [
        r"re:\bghp_[A-Za-z0-9]{20,}",
        r"re:\bgho_[A-Za-z0-9]{20,}",
        r"re:\bghu_[A-Za-z0-9]{20,}",
        r"re:\bghs_[A-Za-z0-9]{20,}",
        r"re:\bghr_[A-Za-z0-9]{20,}",
        r"re:\bgithub_pat_[A-Za-z0-9_]{20,}",
        r"re:\bglpat-[A-Za-z0-9_-]{16,}",
        r"re:\bnpm_[A-Za-z0-9]{20,}",
        r"re:\bpypi-[A-Za-z0-9_-]{16,}",
        r"re:\bxox[baprs]-[A-Za-z0-9-]{10,}",
        r"re:\bsk_live_[A-Za-z0-9]{16,}",
        r"re:\brk_live_[A-Za-z0-9]{16,}",
        r"re:\bSG\.[A-Za-z0-9_-]{16,}",
        r"re:\bsk-ant-[A-Za-z0-9_-]{16,}",
    ],
    "secret_password_hash": [r"re:\$2[aby]\$", "$argon2", "$scrypt$", r"re:\bpbkdf2_"],
    "secret_connection_string": [r"re:(?i)[a-z][a-z0-9+.-]*://[^/\s:@]+:[^/\s:@]+@"],
}
#: Fixed values, found in bytes only, for text never holds it.
RAW_BYTES: dict[str, list[bytes]] = {"deserialization": [b"\x80\x04\x95"]}
#: Entity names that the detector decodes, besides numeric ones.
ENTITIES = {
    "lt": "<",
    "gt": ">",
    "amp": "&",
    "quot": '"',
    "apos": "'",
    "colon": ":",
    "semi": ";",
    "sol": "/",
    "bsol": "\\",
    "equals": "=",
    "lpar": "(",
    "rpar": ")",
    "lcub": "{",
    "rcub": "}",
    "lsqb": "[",
    "rsqb": "]",
    "commat": "@",
    "dollar": "$",
    "num": "#",
    "percnt": "%",
    "period": ".",
    "lowbar": "_",
    "grave": "`",
    "vert": "|",
    "Tab": "\t",
    "NewLine": "\n",
}


#: For engines that backtrack: patterns that find something in the same texts, but read hostile ones once.
#: A run of letters is entered at its start only, and what was read is not given back.
LINEAR = {
    r"(?i)[a-z][a-z0-9+.-]*://[^/\s:@]+:[^/\s:@]+@": r"(?i)(?<![a-z0-9+.\-])[0-9+.\-]*+[a-z][a-z0-9+.\-]*+://[^/\s:@]++:[^/\s:@]++@",
    r"eyJ[A-Za-z0-9_-]{5,}\.[A-Za-z0-9_-]{5,}\.[A-Za-z0-9_-]*": r"(?<![A-Za-z0-9_-])(?:(?!eyJ)[A-Za-z0-9_-])*+eyJ[A-Za-z0-9_-]{5,}+\.[A-Za-z0-9_-]{5,}+\.",
    r"(?i)^\s*system:": r"(?i)^[^\S\n]*+system:",
    r"(?i)^\s*assistant:": r"(?i)^[^\S\n]*+assistant:",
}


def _tokens(extra: dict[str, list[str]] | None) -> dict[str, list[str]]:
    return {name: tokens + (extra or {}).get(name, []) for name, tokens in (CLASSES | SECRETS).items()}


def patterns(extra: dict[str, list[str]] | None = None, *, linear: bool = False) -> dict[str, str]:
    """One alternation per class that has tokens; ``extra`` adds literals to classes, as for an incident; ``linear`` for engines that backtrack."""
    out = {}
    for name, tokens in _tokens(extra).items():
        parts = [_scoped(LINEAR.get(t[3:], t[3:]) if linear else t[3:]) if t.startswith("re:") else re.sub(r"([^\w\s])", r"\\\1", t) for t in tokens]
        if parts:
            out[name] = "|".join(parts)
    return out


@dataclass(frozen=True)
class Search:
    """One token of a class, with what a text must hold for it to be found; ``pattern`` is read only where the rest holds."""

    #: Texts that all stand in every match, lower-case if ``folded``.
    pieces: tuple[str, ...]
    #: Letters of either case count, and those few beyond ASCII that fold into ASCII ones (:data:`ODD`).
    folded: bool = False
    #: None if the pieces decide (but for texts with :data:`ODD` letters).
    pattern: str | None = None
    #: The one piece must stand at the start of a line.
    starts: bool = False
    #: No ASCII text matches.
    wide: bool = False

    @property
    def gate(self) -> str:
        """A character of every match that few texts hold; "" if it has letters only."""
        return next((c for c in GATES if any(c in x for x in self.pieces)), "")


#: From rare to common in texts.
GATES = "`|{}$\\<%!@*_\t\r+#&=;)(/\"':0192345678-."
#: Letters that a search without regard to case takes for k, s or i.
ODD = "\u212a\u017f\u0130\u0131"


def searches(extra: dict[str, list[str]] | None = None, only: Collection[str] | None = None) -> dict[str, list[Search]]:
    """The searches of each class that has tokens, or of the classes in ``only``."""
    return {name: [s for t in tokens for s in _searches(t)] for name, tokens in _tokens(extra).items() if tokens and (only is None or name in only)}


def _searches(token: str) -> list[Search]:
    if not token.startswith("re:"):
        return [Search((token,))]
    pattern = token[3:]
    if m := re.fullmatch(r"\^\[((?:\\[^a-zA-Z0-9]|\\[trf]|[^\\\]^-])+)\]", pattern):
        return [Search(({"t": "\t", "r": "\r", "f": "\f"}.get(c[1:], c[-1]),), starts=True) for c in re.findall(r"\\.|.", m[1])]
    folded, body = pattern.startswith("(?i)"), pattern.removeprefix("(?i)")
    linear = _scoped(LINEAR.get(pattern, pattern))
    if re.fullmatch(r"(?:\\[^a-zA-Z0-9]|[^\\.^$|+*?{}()\[\]])+", body) and body.isascii():
        text = re.sub(r"\\(.)", r"\1", body)
        return [Search((text.lower() if folded else text,), folded, linear if folded else None)]
    needed = _needed(body)
    return [Search(tuple(x.lower() if folded else x for x in needed or ()), folded, linear, wide=needed is None)]


def decides(search: Search) -> bool:
    """Whether its pieces alone find it in a text without :data:`ODD` letters."""
    return search.pattern is None or (search.folded and len(search.pieces) == 1 and re.sub(r"\\(.)", r"\1", search.pattern[4:-1]).lower() == search.pieces[0])


def _needed(body: str) -> list[str] | None:
    """Texts that all stand in every match of the pattern; None if no ASCII text matches."""
    if re.fullmatch(r"\[[^\]]*\]", body) and not any(re.search(body, chr(i)) for i in range(128)):
        return None
    # Letters of a class, a group, an escape such as \b and what may stand more or fewer times end a run of plain letters.
    plain = re.sub(r"\[(?:\\.|[^\]])*\]|\((?:\\.|[^)])*\)|\\[a-zA-Z]", "\0", body)
    plain = re.sub(r"(?:\\.|.)(?:[*?]|\{[^}]*\})", "\0", plain, flags=re.DOTALL)
    if re.search(r"(?<!\\)\|", plain):
        return []
    plain = re.sub(r"\\(.)|[.^$+]", lambda m: m[1] or "\0", plain)
    pieces = sorted({x for x in plain.split("\0") if x}, key=lambda x: (-len(x), x))
    return [x for i, x in enumerate(pieces) if not any(x in y for y in pieces[:i])]


def _scoped(pattern: str) -> str:
    """A leading case flag bound to its own alternative, in the form that both Java and Python read."""
    return f"(?i:{pattern[4:]})" if pattern.startswith("(?i)") else f"(?:{pattern})"
