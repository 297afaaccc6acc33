"""Error kinds and their exit codes: a finding blocks, a usage error is the caller's, an infra error may be retried."""

from __future__ import annotations


class AuditError(Exception):
    exit_code = 1


class FindingError(AuditError):
    """The data breaks its contract."""

    exit_code = 1


class UsageError(AuditError):
    """The request or a document is wrong."""

    exit_code = 2


class InfraError(AuditError):
    """The surroundings failed; the same request may work later."""

    exit_code = 3


def gravest(errors: list[AuditError]) -> AuditError | None:
    """The error to report of several that happened at once: a finding before an infra error."""
    order = {FindingError: 0, UsageError: 1, InfraError: 2}
    return min(errors, key=lambda e: order.get(type(e), 3), default=None)
