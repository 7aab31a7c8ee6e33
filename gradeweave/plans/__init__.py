"""Plans: whole jobs put together from sources and operators."""
