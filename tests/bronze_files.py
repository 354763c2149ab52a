"""Hand-made raw files of two sessions, written with the csv module as the exporter would."""

import csv
import json
import os


def _write(root, name, header, rows):
    with open(os.path.join(root, name), "w", newline="", encoding="utf-8") as f:
        out = csv.writer(f)
        out.writerow(header)
        out.writerows(rows)


RESULTS = "DriverNumber,Abbreviation,TeamName,TeamColor,TeamId,FirstName,LastName,FullName,CountryCode,Position,ClassifiedPosition,GridPosition,Q1,Q2,Q3,Time,Status,Points,Laps,SessionId".split(",")
LAPS = "Time,Driver,DriverNumber,LapTime,LapNumber,Stint,PitOutTime,PitInTime,Sector1Time,Sector2Time,Sector3Time,SpeedI1,SpeedI2,SpeedFL,SpeedST,IsPersonalBest,Compound,TyreLife,FreshTyre,Position,TrackStatus,IsAccurate,SessionId".split(",")
TELEMETRY = "Date,SessionTime,RPM,Speed,nGear,Throttle,Brake,DRS,X,Y,Z,Distance,Driver,SessionId".split(",")
WEATHER = "Time,AirTemp,Humidity,Pressure,Rainfall,TrackTemp,WindDirection,WindSpeed,SessionId".split(",")
MESSAGES = "Time,Category,Message,Status,Flag,Scope,Sector,RacingNumber,Lap,SessionId".split(",")


def driver(number, code, team, position, status, sid, grid=None, classified=None):
    team_id = team.lower()
    return [number, code, team, "AABBCC", team_id, code.title(), "X", f"{code.title()} X", "GBR", f"{position}.0", classified or f"{position}.0", f"{grid or position}.0", "", "", "", "5400.1234", status, "25.0", "2.0", sid]


def lap(code, n, time, stint, compound, life, position, sid, accurate="True", at=None):
    return [at or 60.0 + 100 * n, code, "", time, f"{n}.0", f"{stint}.0", "", "", "30.1", "30.2", "", "280.0", "", "", "", "True" if n == 2 else "", compound, f"{life}.0", "True", position, "1", accurate, sid]


def write_session(root, year, gp, drivers, laps, telemetry_rows, with_weather=True):
    sid = f"{year}_{gp}_R"
    _write(root, f"results_{sid}.csv", RESULTS, [driver(*d, sid) for d in drivers])
    _write(root, f"laps_{sid}.csv", LAPS, [lap(*row, sid) for row in laps])
    _write(root, f"telemetry_{sid}.csv", TELEMETRY, [[*row, sid] for row in telemetry_rows])
    if with_weather:
        _write(root, f"weather_{sid}.csv", WEATHER, [[30.0, 25.15, 70.0, 1009.5, "False", 40.0, 100, 1.5, sid], [95.0, 26.0, 70.0, 1009.5, "True", 41.0, 100, 1.5, sid], ["", 1, 1, 1, "False", 1, 1, 1, sid]])
    _write(root, f"track_status_{sid}.csv", ["Time", "Status", "Message", "SessionId"], [[10.0, 1, "AllClear", sid], [10.0, 1, "AllClear", sid], [20.0, 2, "Yellow", sid]])
    _write(root, f"session_status_{sid}.csv", ["Time", "Status", "SessionId"], [[0.0, "Inactive", sid], [95.0, "Started", sid], [95.0, "Aborted", sid]])
    _write(
        root,
        f"race_control_messages_{sid}.csv",
        MESSAGES,
        [
            ["2024-09-22 12:00:00", "Flag", 'GREEN LIGHT - "PIT" EXIT, OPEN', "", "GREEN", "Track", "", "", 1, sid],
            ["2024-09-22 12:01:30", "SafetyCar", "SAFETY CAR DEPLOYED\nEVERYWHERE ON THE WHOLE TRACK UNTIL FURTHER NOTICE", "", "", "", "", "", 2, sid],
            ["", "", "INCIDENT NOTED", "", "", "", "", 4, "", sid],
        ],
    )
    info = {"Meeting": {"Location": f"{gp} Town", "Country": {"Code": "SGP", "Name": gp}}, "StartDate": "2024-09-22T20:00:00", "Parts": [1, 2, 3, 4, 5, 6, 7]}
    doc = {"exported_at": "2024-09-23T00:00:00Z", "data": {"session_id": sid, "year": year, "gp": gp, "session_type": "R", "session_name": "Race", "event_name": f"{gp} GP", "data": info}}
    with open(os.path.join(root, f"session_info_{sid}.json"), "w", encoding="utf-8") as f:
        json.dump(doc, f, indent=2)
    return sid


def telemetry(number, n, brake_every=4):
    return [[f"2024-09-22 12:00:{i % 60:02d}.250000", 0.25 * i, 11000 + i, 100 + 10 * (i % 15), 7, 80, "True" if i % brake_every == 0 else "False", 12 if i % 5 == 0 else 0, 800 + i, 1150 + i, 1.0, 2.0 * i, number] for i in range(n)]


def write_all(root):
    first = [(4, "NOR", "McLaren", 1, "Finished"), (81, "PIA", "McLaren", 2, "+3 Laps"), (1, "VER", "RedBull", 3, "Fire", None)]
    laps = [
        ("NOR", 1, 101.5, 1, " soft ", 1, 1), ("NOR", 2, 100.0, 1, "SOFT", 2, 2), ("NOR", 3, 102.25, 2, "c6", 1, 2),
        ("PIA", 1, 103.0, 1, "HARD", 1, 2), ("PIA", 2, "", 1, "HARD", 2, 3), ("PIA", 3, 104.0, 1, "HARD", 3, 3),
        ("VER", 1, 99.0, 1, "", 1, 3), ("VER", 2, 99.5, 1, "", 2, 1), ("VER", 3, 99.25, 1, "", 3, 1), ("ZZZ", 1, 99.0, 1, "SOFT", 1, 9),
    ]
    write_session(root, 2024, "Singapore", first, laps, telemetry(4, 100) + telemetry(81, 60) + telemetry(99, 10))
    second = [(4, "NOR", "RedBull", 2, "Finished"), (1, "VER", "RedBull", 1, "Finished")]
    write_session(root, 2024, "Monaco", second, [("NOR", 1, 80.0, 1, "SOFT", 1, 2), ("VER", 1, 79.0, 1, "SOFT", 1, 1)], telemetry(1, 25), with_weather=False)
