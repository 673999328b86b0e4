"""Part of plinth."""
