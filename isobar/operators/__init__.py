"""Reusable DataFrame operators: bronze steps, silver, ranking, nearest point, paging, filters."""
