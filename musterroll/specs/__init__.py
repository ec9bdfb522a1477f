"""Table specs and the catalogue that holds them."""

from musterroll.specs.model import Catalog, ColumnSpec, TableSpec, columns
from musterroll.specs.registers import REGISTERS

__all__ = ["Catalog", "ColumnSpec", "TableSpec", "columns", "REGISTERS"]
