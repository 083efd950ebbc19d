"""A small, deterministic season of match logs in all file dialects."""

from __future__ import annotations

import csv
import datetime as dt
import random
from pathlib import Path

HEROES = {
    "tank": ["Reinhardt", "Zarya", "D.Va", "Sigma"],
    "damage": ["Tracer", "Torbj", "Pharah", "Genji"],
    "support": ["Lúcio", "Mercy", "Ana", "Zenyatta"],
}
STATS = ["Hero Damage Done", "Deaths", "Eliminations", "Final Blows", "Solo Kills", "Assists", "Defensive Assists", "Healing Done"]
PATCHES = [("Patch 1.18", "1/1/2018", "2/15/2018"), ("Patch 1.19c", "2/16/2018", "12/31/2018"),
           ("Patch 1.32", "1/1/2019", "12/31/2019"), ("Week 5", "1/1/2020", "12/31/2020")]
FILES = {  # file: (year, stage in the file, header, time format)
    "phs_2018_stage_1.csv": (2018, "Overwatch League - Stage 1", "short", "%m/%d/%Y %H:%M"),
    "phs_2019_stage_1.csv": (2019, "Overwatch League Stage 1", "pel", "%m/%d/%Y %H:%M"),
    "phs_2019_stage_2.csv": (2019, "Overwatch League Stage 2", "short", "%m/%d/%Y %H:%M"),
    "phs_2020_1.csv": (2020, "OWL 2020 Regular Season", "long", "%m/%d/%Y %H:%M"),
    "phs_2020_2.csv": (2020, "OWL 2020 Regular Season", "long", "%Y-%m-%d %H:%M:%S"),
}
HEADERS = {
    "short": ["start_time", "match_id", "stage", "map_type", "map_name", "player", "team", "stat_name", "hero", "stat_amount"],
    "pel": ["pelstart_time", "match_id", "stage", "map_type", "map_name", "player", "team", "stat_name", "hero", "stat_amount"],
    "long": ["start_time", "esports_match_id", "tournament_title", "map_type", "map_name", "player_name", "team_name",
             "stat_name", "hero_name", "stat_amount"],
}
ROUND_HEADER = [
    "round_start_time", "round_end_time", "stage", "match_id", "game_number", "match_winner", "map_winner", "map_loser",
    "map_name", "map_round", "winning_team_final_map_score", "losing_team_final_map_score", "control_round_name",
    "attacker", "defender", "team_one_name", "team_two_name", "attacker_payload_distance", "defender_payload_distance",
    "attacker_time_banked", "defender_time_banked", "attacker_control_perecent", "defender_control_perecent",
    "attacker_round_end_score", "defender_round_end_score",
]


def write(folder: Path, matches_per_file: int = 9, seed: int = 5) -> None:
    rng = random.Random(seed)
    (folder / "csvs").mkdir(parents=True)
    with open(folder / "patch_map.csv", "w", encoding="utf-8-sig", newline="") as f:
        out = csv.writer(f)
        out.writerow(["Patch", "Start Date", "End Date"])
        out.writerows(PATCHES)
    teams = {t: [(f"{t}{k}", role) for k, role in enumerate(["tank", "tank", "damage", "damage", "support", "support"])]
             for t in ("Alpha", "Beta", "Gamma", "Delta")}
    strength = {"Alpha": 0.8, "Beta": 0.3, "Gamma": -0.2, "Delta": -0.9}
    rounds, number = [], 21340
    for name, (year, stage, header, pattern) in FILES.items():
        rows = []
        for m in range(matches_per_file):
            number += 1
            one, two = rng.sample(sorted(teams), 2)
            shown = "OWL APAC All-Stars" if m == 0 and name == "phs_2020_1.csv" else stage
            day = dt.datetime(year, 2, 14, 12) + dt.timedelta(days=2 * m)
            for game in range(1, 5):
                start = day + dt.timedelta(minutes=30 * game)
                kind, label = [("CONTROL", "Ilios"), ("HYBRID", "Hollywood"), ("ASSAULT", "Hanamura")][game % 3]
                first = rng.choice([one, two])
                edge = strength[one] - strength[two] + (0.3 if first == one else -0.3)
                won = one if rng.random() < 1 / (1 + 2.718281828**-edge) else two
                draw = rng.random() < 0.05
                winner, loser = ("draw", "draw") if draw else (won, two if won == one else one)
                for number_in_map in (1, 2):
                    attacker = first if number_in_map == 1 else (two if first == one else one)
                    at = start + dt.timedelta(minutes=10 * (number_in_map - 1))
                    rounds.append([at.strftime("%Y-%m-%d %H:%M:%S"), (at + dt.timedelta(minutes=9)).strftime("%Y-%m-%d %H:%M:%S"),
                                   shown, number, game, one, winner, loser, label, number_in_map, 2 if draw else 3, 2, "NA",
                                   attacker, two if attacker == one else one, one, two, 10.5, "", 0, 0, "NA", "NA", 1, 0])
                for team in (one, two):
                    better = team == won
                    for player, role in teams[team][:]:
                        who = player if rng.random() < 0.8 else player + "sub"
                        heroes = rng.sample(HEROES[role], 2)
                        left = 600.0
                        for k, hero in enumerate(heroes):
                            time = left if k else rng.choice([400.0, 300.0])
                            left -= time if not k else 0
                            rows.append([start.strftime(pattern), number, shown, kind, label, who, team, "Time Played", hero, time])
                        for stat in STATS + ["Time Played"]:
                            base = {"Deaths": 5 - 1.0 * better, "Final Blows": 5 + 1.0 * better}.get(stat, 8)
                            rows.append([start.strftime(pattern), number, shown, kind, label, who, team, stat, "All Heroes",
                                         600.0 if stat == "Time Played" else float(max(0, round(rng.gauss(base, 2.5))))])
        with open(folder / "csvs" / name, "w", encoding="utf-8", newline="") as f:
            out = csv.writer(f)
            out.writerow(HEADERS[header])
            out.writerows(rows)
    with open(folder / "csvs" / "match_map_stats.csv", "w", encoding="utf-8", newline="") as f:
        out = csv.writer(f)
        out.writerow(ROUND_HEADER)
        out.writerows(rounds)
