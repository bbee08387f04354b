"""Commands and their lifecycle: a registry of named callables with hooks around each run."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from .registry import coerce


@dataclass
class Command:
    """A named query: columns it returns, arguments it takes, and the function or step spec that makes it."""

    name: str
    func: Callable[..., DataFrame]
    args: list[dict] = field(default_factory=list)
    columns: list[str] | None = None
    validate: Callable[[dict], None] | None = None


class Commands:
    def __init__(self):
        self._by_name: dict[str, Command] = {}
        self.before: list[Callable] = []
        self.after: list[Callable] = []

    def register(self, command: Command, *aliases: str) -> None:
        problems = [a["name"] for i, a in enumerate(command.args) if a["name"] in {x["name"] for x in command.args[:i]}]
        if problems:
            raise ValueError(f"repeated argument {problems[0]}")
        for n in (command.name, *aliases):
            self._by_name[n] = command

    def names(self) -> list[str]:
        return sorted(self._by_name)

    def run(self, spark: SparkSession, name: str, given: dict | None = None) -> DataFrame:
        """Arguments are bound and validated, then hooks and the function run; columns are projected last."""
        c = self._by_name[name]
        args = coerce(c.args, given or {})
        if c.validate:
            c.validate(args)
        for hook in self.before:
            hook(c, args)
        df = c.func(spark, **args)
        if c.columns:
            from pyspark.sql import functions as F

            df = df.select(*[F.col(x) if x in df.columns else F.lit("").alias(x) for x in c.columns])
        for hook in self.after:
            hook(c, args, df)
        return df
