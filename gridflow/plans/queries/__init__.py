"""Query definitions grouped by area; each module registers into the catalog."""
