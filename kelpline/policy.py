"""What may be published, and whether sensitive values are masked."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column
from pyspark.sql import functions as F

from kelpline import model

RESTRICT_BY_DEFAULT = False


def restrict_policy(restrict: bool | None = None) -> bool:
    """An explicit flag wins, otherwise the default applies."""
    return RESTRICT_BY_DEFAULT if restrict is None else restrict


@dataclass(frozen=True)
class Policy:
    """Run-wide settings, known before any plan is built.

    A data type that is ``unrestricted`` also counts as listed in ``only``; one
    unrestricted type therefore keeps every type outside ``only`` from being published.
    """

    restrict: bool | None = None
    only: tuple[str, ...] = ()
    dont: tuple[str, ...] = ()
    unrestricted: tuple[str, ...] = ()
    keep_folders: tuple[str, ...] = (model.PROFILE,)

    @property
    def restricting(self) -> bool:
        return restrict_policy(self.restrict)

    @property
    def only_types(self) -> tuple[str, ...]:
        return self.only + self.unrestricted

    def with_restrict(self, restrict: bool) -> Policy:
        return replace(self, restrict=restrict)

    def allows(self, data_type: Column) -> Column:
        """TRUE where a package of this data type may be published."""
        if not self.restricting:
            return F.lit(True)
        data_type = F.coalesce(data_type, F.lit(""))
        allowed = F.lit(True)
        if self.only_types:
            allowed = allowed & data_type.isin(*self.only_types)
        if self.dont:
            allowed = allowed & ~data_type.isin(*self.dont)
        return allowed

    def masks(self, data_type: Column) -> Column:
        """TRUE where the restricting steps act on a row of this data type."""
        if not self.restricting:
            return F.lit(False)
        if not self.unrestricted:
            return F.lit(True)
        return ~F.coalesce(data_type, F.lit("")).isin(*self.unrestricted)

    def prunes(self, data_type: Column) -> Column:
        """TRUE where folders and readmes are dropped from a package."""
        if not self.restricting:
            return F.lit(False)
        kept = self.unrestricted + self.keep_folders
        if not kept:
            return F.lit(True)
        return ~F.coalesce(data_type, F.lit("")).isin(*kept)
