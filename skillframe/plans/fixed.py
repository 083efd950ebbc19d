"""Fixed values of the rating recipe: names, lists and rules that decide the results."""

from __future__ import annotations

from ..operators.lookup import Clause, Rule
from ..sources.files import ISO_TIME, Dialect
from ..functions.dates import US_TIME

# Stage names as they occur in the files, and the names used from then on.
STAGES = {
    "Overwatch League - Stage 1": "2018 Stage 1 Regular Season",
    "Overwatch League - Stage 1 - Title Matches": "2018 Stage 1 Title Matches",
    "Overwatch League - Stage 2": "2018 Stage 2 Regular Season",
    "Overwatch League - Stage 2 Title Matches": "2018 Stage 2 Title Matches",
    "Overwatch League - Stage 3": "2018 Stage 3 Regular Season",
    "Overwatch League - Stage 3 Title Matches": "2018 Stage 3 Title Matches",
    "Overwatch League - Stage 4": "2018 Stage 4 Regular Season",
    "Overwatch League - Stage 4 Title Matches": "2018 Stage 4 Title Matches",
    "Overwatch League Inaugural Season Championship": "2018 Playoffs",
    "Overwatch League Stage 1": "2019 Stage 1 Regular Season",
    "Overwatch League Stage 1 Title Matches": "2019 Stage 1 Title Matches",
    "Overwatch League Stage 2": "2019 Stage 2 Regular Season",
    "Overwatch League Stage 2 Title Matches": "2019 Stage 2 Title Matches",
    "Overwatch League Stage 3": "2019 Stage 3 Regular Season",
    "Overwatch League Stage 3 Title Matches": "2019 Stage 3 Title Matches",
    "Overwatch League Stage 4": "2019 Stage 4 Regular Season",
    "Overwatch League 2019 Post-Season": "2019 Playoffs",
    "OWL 2020 Regular Season": "2020 Regular Season and Playoffs",
}

# Exhibition stages that are left out.
EXHIBITIONS = ("OWL APAC All-Stars", "OWL North America All-Stars")

# Hero names as they occur in the files, and the names used from then on.
HEROES = {"Lúcio": "Lucio", "Torbj": "Torbjorn"}

# Start times that are wrong in the files.
START_TIME_FIXES = [("21352", "1", "2019-04-27 16:55:00")]

# Seasons, in the order in which a stage name is searched for them.
SEASONS = ("2018", "2019", "2020")

# Heroes by role. Torbjorn stands under both spellings; see ``compat_roles``.
SUPPORT = ("Lucio", "Moira", "Brigitte", "Zenyatta", "Mercy", "Ana", "Baptiste")
TANK = ("Reinhardt", "Sigma", "Wrecking Ball", "Zarya", "Winston", "D.Va", "Roadhog", "Orisa")
HITSCAN = (
    "Ashe", "Bastion", "McCree", "Reaper", "Soldier: 76", "Sombra", "Symmetra", "Tracer", "Widowmaker",
)
PROJECTILE = ("Doomfist", "Echo", "Genji", "Hanzo", "Junkrat", "Mei", "Pharah", "Torbj", "Torbjorn")

# Statistics used by the models, and the text that marks a player's total over heroes.
ALL_HEROES = "All Heroes"
TIME_PLAYED = "Time Played"
TEAM_STATS = (
    "Hero Damage Done", "Deaths", "Eliminations", "Final Blows", "Solo Kills", "Assists", "Defensive Assists",
    "Healing Done", "Time Played",
)
PLAYER_STATS = ("Deaths", "Final Blows")
SUBROLES = ("DPS", "main_support", "main_tank", "off_support", "off_tank")
NEUTRAL_MAP_TYPE = "CONTROL"

# Columns of the round log.
ROUND_SCHEMA = {
    "round_start_time": "timestamp_ntz",
    "round_end_time": "timestamp_ntz",
    "stage": "string",
    "match_id": "string",
    "game_number": "string",
    "match_winner": "string",
    "map_winner": "string",
    "map_loser": "string",
    "map_name": "string",
    "map_round": "string",
    "winning_team_final_map_score": "double",
    "losing_team_final_map_score": "double",
    "control_round_name": "string",
    "attacker": "string",
    "defender": "string",
    "team_one_name": "string",
    "team_two_name": "string",
    "attacker_payload_distance": "double",
    "defender_payload_distance": "double",
    "attacker_time_banked": "double",
    "defender_time_banked": "double",
    "attacker_control_perecent": "double",
    "defender_control_perecent": "double",
    "attacker_round_end_score": "double",
    "defender_round_end_score": "double",
}

# Columns of the player log.
PLAYER_SCHEMA = {
    "start_time": "timestamp_ntz",
    "match_id": "string",
    "stage": "string",
    "map_type": "string",
    "map_name": "string",
    "player": "string",
    "team": "string",
    "stat_name": "string",
    "hero": "string",
    "stat_amount": "double",
}

# Spellings of the player files.
_LONG_NAMES = {
    "esports_match_id": "match_id",
    "tournament_title": "stage",
    "player_name": "player",
    "team_name": "team",
    "hero_name": "hero",
}
ROUND_FILE = "match_map_stats.csv"
ROUND_DIALECT = Dialect("rounds", {}, ISO_TIME)
PLAYER_DIALECTS = {
    "phs_2020_2.csv": Dialect("long names, ISO time", _LONG_NAMES, ISO_TIME),
    "phs_2020_1.csv": Dialect("long names, US time", _LONG_NAMES, US_TIME),
    "phs_2019_stage_1.csv": Dialect("prefixed start time", {"pelstart_time": "start_time"}, US_TIME),
}
PLAYER_DEFAULT = Dialect("canonical names, US time", {}, US_TIME)

# Subrole rules, first match wins. A lone Mercy is one without a flying partner.
_LONE_MERCY = Clause(any_of=("Mercy",), none_of=("Pharah", "Echo"))
_BIG_THREE = ("Reinhardt", "Orisa", "Winston")


def subrole_rules(compat: bool = False) -> list[Rule]:
    """``compat=True`` leaves Torbjorn without a subrole, as lists that only know the short spelling do."""
    shooters = HITSCAN + PROJECTILE
    if compat:
        shooters = tuple(h for h in shooters if h != "Torbjorn")
    return [
        Rule(shooters, "DPS"),
        Rule(("Lucio",), "off_support", ((Clause(("Moira",)), _LONE_MERCY),)),
        Rule(("Lucio", "Moira"), "main_support"),
        Rule(("Brigitte",), "off_support", ((Clause(("Lucio", "Moira", "Ana", "Baptiste")), _LONE_MERCY),)),
        Rule(("Brigitte",), "main_support"),
        Rule(("Zenyatta",), "off_support"),
        Rule(("Ana",), "off_support", ((Clause(("Lucio", "Moira", "Baptiste")), _LONE_MERCY),)),
        Rule(("Ana",), "main_support"),
        Rule(("Baptiste",), "off_support", ((Clause(("Lucio", "Moira")), _LONE_MERCY),)),
        Rule(("Baptiste",), "main_support"),
        Rule(
            ("Mercy",),
            "off_support",
            ((Clause(("Pharah", "Echo"), ("Zenyatta",)),), (Clause(("Moira", "Lucio")),)),
        ),
        Rule(("Mercy",), "main_support"),
        Rule(_BIG_THREE, "main_tank"),
        Rule(("Sigma",), "main_tank", ((Clause(none_of=_BIG_THREE),),)),
        Rule(("Sigma",), "off_tank"),
        Rule(("Wrecking Ball",), "off_tank", ((Clause(_BIG_THREE + ("Sigma",)),),)),
        Rule(("Wrecking Ball",), "main_tank"),
        Rule(("Zarya",), "off_tank", ((Clause(_BIG_THREE + ("Sigma", "Wrecking Ball")),),)),
        Rule(("Zarya",), "main_tank"),
        Rule(("D.Va",), "off_tank", ((Clause(_BIG_THREE + ("Sigma", "Wrecking Ball", "Zarya")),),)),
        Rule(("D.Va",), "main_tank"),
        Rule(("Roadhog",), "off_tank"),
    ]


def hero_roles(compat: bool = False) -> dict[str, str]:
    damage = HITSCAN + PROJECTILE
    if compat:
        damage = tuple(h for h in damage if h != "Torbjorn")
    roles = {h: "support" for h in SUPPORT}
    roles.update({h: "damage" for h in damage})
    roles.update({h: "tank" for h in TANK})
    return roles
