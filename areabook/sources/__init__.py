from areabook.sources.inputs import Inputs  # noqa: F401
