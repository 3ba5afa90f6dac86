from turnout.operators import charts, cleaning, encoding, profiles, quality, ranking

__all__ = ["charts", "cleaning", "encoding", "profiles", "quality", "ranking"]
