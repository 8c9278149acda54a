"""End-to-end chains over the operators."""
