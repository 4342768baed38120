from tidewell.sources import files, warehouse
from tidewell.sources.base import Source, create, names, register

__all__ = ["Source", "create", "files", "names", "register", "warehouse"]
