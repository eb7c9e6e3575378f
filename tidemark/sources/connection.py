"""Connection strings: ``key=value`` pairs with quoted values, read once for login and for redaction."""

from __future__ import annotations

import re

# A value may stand in double or single quotes or in braces; the closing mark doubled stands for itself.
_PAIR = re.compile(
    r"""\s*(?P<key>[^=;]+?)\s*=\s*(?:"(?P<double>(?:[^"]|"")*)"|'(?P<single>(?:[^']|'')*)'|\{(?P<brace>(?:[^}]|\}\})*)\}|(?P<plain>[^;]*?))\s*(?:;|$)"""
)
_CLOSING = {"double": '"', "single": "'", "brace": "}"}

# Accepted spellings of keys, and the JDBC driver's property for each setting passed on.
SPELLINGS = {
    "server": ("server", "data source", "address", "addr", "network address"),
    "database": ("database", "initial catalog"),
    "user": ("user id", "uid", "user"),
    "password": ("password", "pwd"),
    "integrated": ("integrated security", "trusted_connection"),
}
PROPERTIES = {
    "encrypt": "encrypt",
    "trustservercertificate": "trustServerCertificate",
    "trust server certificate": "trustServerCertificate",
    "hostnameincertificate": "hostNameInCertificate",
    "applicationintent": "applicationIntent",
    "application intent": "applicationIntent",
    "application name": "applicationName",
    "app": "applicationName",
    "authentication": "authentication",
    "multisubnetfailover": "multiSubnetFailover",
    "failover partner": "failoverPartner",
    "packet size": "packetSize",
    "workstation id": "workstationID",
    "wsid": "workstationID",
    "connect timeout": "loginTimeout",
    "connection timeout": "loginTimeout",
    "timeout": "loginTimeout",
}
# Settings of a client's own pooling, without meaning for a read by Spark.
WITHOUT_EFFECT = (
    "pooling", "min pool size", "max pool size", "persist security info", "multipleactiveresultsets", "connection lifetime", "enlist",
)


def settings(text: str) -> dict[str, str]:
    """Keys in lower case and their values without quotes; of repeated keys the last counts."""
    found = {}
    for m in _PAIR.finditer(text):
        kind = next((k for k in _CLOSING if m[k] is not None), None)
        value = m[kind].replace(_CLOSING[kind] * 2, _CLOSING[kind]) if kind else m["plain"]
        found[m["key"].lower()] = value
    return found


def chosen(found: dict[str, str], what: str) -> str | None:
    """The value under any spelling of a setting; None if it is blank or not there."""
    return next((found[k] for k in SPELLINGS[what] if found.get(k)), None)


def unknown(found: dict[str, str]) -> list[str]:
    """Keys that nothing here understands."""
    known = {s for spellings in SPELLINGS.values() for s in spellings} | set(PROPERTIES) | set(WITHOUT_EFFECT)
    return sorted(set(found) - known)


def secrets_of(text: str) -> tuple[str, ...]:
    """The password, and how it is written in the string where that differs."""
    forms = []
    for m in _PAIR.finditer(text):
        if m["key"].lower() in SPELLINGS["password"]:
            kind = next((k for k in _CLOSING if m[k] is not None), None)
            value = m[kind].replace(_CLOSING[kind] * 2, _CLOSING[kind]) if kind else m["plain"]
            forms += [value, m[kind or "plain"]]
    return tuple(dict.fromkeys(f for f in forms if f))
