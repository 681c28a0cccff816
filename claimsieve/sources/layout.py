"""SRC-06: the folders of one run, all below one base path on any Hadoop file system.

Raw files lie directly below the base. All that a run writes lies in the folder of its version, where there is one.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Layout:
    base: str
    version: str | None = None

    def _below(self, *parts: str) -> str:
        return "/".join([self.base.rstrip("/"), *parts])

    def _in(self, *parts: str) -> str:
        return self._below(*parts) if self.version is None else self._below("versions", self.version, *parts)

    def raw(self, file: str) -> str:
        return self._below("raw", file)

    def versions(self) -> str:
        return self._below("versions")

    def pointer(self, name: str) -> str:
        return self._below(name)

    def stage(self, table: str) -> str:
        return self._in("stage", table)

    def clean(self, table: str) -> str:
        return self._in("clean", table)

    def core(self, table: str) -> str:
        return self._in("core", table)

    def output(self, table: str) -> str:
        return self._in("output", table)

    def null_report(self, table: str) -> str:
        return self._in("logs", "null_report", table)

    def duplicate_report(self, table: str) -> str:
        return self._in("logs", "duplicates", table)

    def quarantine(self, table: str) -> str:
        return self._in("logs", "quarantine", table)

    def key_audit(self, table: str) -> str:
        return self._in("logs", "merged_keys", table)
