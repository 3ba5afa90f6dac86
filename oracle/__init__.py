from oracle.sql import statements

__all__ = ["statements"]
