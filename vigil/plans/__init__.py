"""Plans: the star build, the materialised catalog and the query registry."""


def load_all():
    """Import every module that registers queries; return the registry."""
    from . import registry
    from . import q_core  # noqa: F401
    for mod in ("q_analysis", "q_metrics", "q_quality", "q_cdc", "q_io", "q_stream", "q_more", "q_recon"):
        try:
            __import__(f"{__name__}.{mod}")
        except ModuleNotFoundError as e:
            if e.name != f"{__name__}.{mod}":
                raise
    return registry
