"""Rules of the student table's gaming score, as data for ``functions.rules``."""

from __future__ import annotations

from tabkit.functions.rules import ClassRule, Rule, ScoreSpec

# Thresholds, points and class names of the gaming score.
GAMING_SCORE = ScoreSpec(
    zero_when="gaming_hours = 0",
    tiers=(Rule("gaming_hours <= 2.0", 1.0), Rule("gaming_hours <= 4.0", 2.0)),
    otherwise=3.0,
    bonuses=(
        Rule("youtube_hours > 3.5", 0.5),
        Rule("social_media_hours > 5.0", 0.3),
        Rule("sleep_hours < 5.0", 0.5),
        Rule("phone_usage_hours > 8.0", 0.3),
        Rule("stress_level >= 8", 0.2),
        Rule("age <= 20", 0.3),
        Rule("gender = 'Other'", 0.1),
    ),
    null_inputs=("gaming_hours",),
)

GAMING_CLASSES = (
    ClassRule("score_gamer = 0", "No Juega"),
    ClassRule("score_gamer >= 2.5", "Experto Gamer"),
    ClassRule("score_gamer >= 1.5", "Gamer"),
)
GAMING_OTHERWISE = "Novato"
GAMING_ORDER = ("No Juega", "Novato", "Gamer", "Experto Gamer")
