"""Page furniture by class name, and pages whose tags are not all closed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from vacancia.functions.elements import balanced, without
from vacancia.functions.rules import any_keyword
from vacancia.functions.text import STRUCTURAL_TAGS, col, structural_html

# Parts of class names that mark page furniture.
NOISE_CLASSES = ("nav", "menu", "header", "footer", "sidebar")
CLASS_VALUE = r"""(?is)\sclass\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""


def closed_structural_html(html: Column | str, tags: Sequence[str] = STRUCTURAL_TAGS) -> Column:
    """The structural clean for pages whose tags are not all closed: they are closed here."""
    return structural_html(balanced(col(html)), tags)


def without_classes(html: Column | str, classes: Sequence[str] = NOISE_CLASSES) -> Column:
    """A page without the elements whose class contains one of the words, nested content included."""

    def furniture(tok: Column, name: Column) -> Column:
        names = F.concat(*[F.regexp_extract(tok, CLASS_VALUE, i) for i in (1, 2, 3)])
        return any_keyword(F.lower(names), [c.lower() for c in classes])

    return without(col(html), furniture)
