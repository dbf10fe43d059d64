"""Which runs of which report are committed.

A commit is one small file whose name says it all, so one listing reads all of
them. ``merge`` folds the files into a note; a pickup then costs two listings and
one read, however many runs there have been.
"""

from __future__ import annotations

from typing import NamedTuple
from urllib.parse import quote, unquote

from pyspark.sql import SparkSession

from orderloom.sources.notes import Folder, Notes


class Commit(NamedTuple):
    seq: int
    report: str
    run: str
    #: Arrival days of the run's rows, first and last; empty when there are none.
    first_day: str
    last_day: str

    def file_name(self) -> str:
        parts = [f"{self.seq:09d}", *self[1:]]
        return "=".join(quote(p, safe="") for p in parts)

    @classmethod
    def from_name(cls, name: str) -> Commit:
        seq, *rest = map(unquote, name.split("="))
        return cls(int(seq), *rest)

    def meets(self, days: list[str] | None) -> bool:
        """Whether the run may hold rows of these days."""
        return days is None or any(self.first_day <= day <= self.last_day for day in days)


class CommitLog:
    """One writer at a time; readers see a run once its file is there."""

    def __init__(self, spark: SparkSession, root: str):
        self.files = Folder(spark, f"{root}/commits/files")
        self.notes = Notes(spark, f"{root}/commits/notes")

    def read(self) -> list[Commit]:
        # The files first: what a merge takes from them is in its note by then.
        names = [n for n, _ in self.files.entries() if not n.startswith("_")]
        note = self.notes.latest()
        gone = set(note.get("gone", []))
        merged = [Commit(*c) for c in note.get("commits", [])]
        fresh = [Commit.from_name(n) for n in names if n not in gone]
        return sorted(set(merged) | set(fresh))

    def add(self, commit: Commit) -> None:
        self.files.write(commit.file_name(), "")

    def merge(self, commits: list[Commit]) -> None:
        """Let the note hold these commits and nothing else; files seen so far go.

        A file left over by a stop in between is named in the note as gone.
        """
        names = [n for n, _ in self.files.entries()]
        self.notes.put({"commits": [list(c) for c in commits], "gone": names})
        for name in names:
            self.files.delete(name)
