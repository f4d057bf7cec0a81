"""Fixed values of the season panel: codes, repaired names, column lists and limits."""

# Franchise name -> team code.
TEAM_CODES = {
    "Atlanta Hawks": "ATL",
    "Boston Celtics": "BOS",
    "Brooklyn Nets": "BKN",
    "Charlotte Hornets": "CHA",
    "Chicago Bulls": "CHI",
    "Cleveland Cavaliers": "CLE",
    "Dallas Mavericks": "DAL",
    "Denver Nuggets": "DEN",
    "Detroit Pistons": "DET",
    "Golden State Warriors": "GSW",
    "Houston Rockets": "HOU",
    "Indiana Pacers": "IND",
    "Kansas City Kings": "KCK",
    "Los Angeles Clippers": "LAC",
    "Los Angeles Lakers": "LAL",
    "Memphis Grizzlies": "MEM",
    "Miami Heat": "MIA",
    "Milwaukee Bucks": "MIL",
    "Minnesota Timberwolves": "MIN",
    "New Jersey Nets": "NJN",
    "New Orleans Hornets": "NOP",
    "New Orleans Pelicans": "NOP",
    "New Orleans/Oklahoma City Hornets": "NOP",
    "New York Knicks": "NYK",
    "Oklahoma City Thunder": "OKC",
    "Orlando Magic": "ORL",
    "Philadelphia 76ers": "PHI",
    "Phoenix Suns": "PHX",
    "Portland Trail Blazers": "POR",
    "Sacramento Kings": "SAC",
    "San Antonio Spurs": "SAS",
    "Seattle SuperSonics": "OKC",
    "Toronto Raptors": "TOR",
    "Utah Jazz": "UTA",
    "Vancouver Grizzlies": "MEM",
    "Washington Bullets": "WAS",
    "Washington Wizards": "WAS",
}

# Team renamed before its code is looked up.
TEAM_RENAMES = {"Charlotte Bobcats": "Charlotte Hornets"}

# Codes of other eras and sources -> code used here.
ERA_CODES = {"BRK": "BKN", "CHO": "CHA", "NOK": "NOP", "NOH": "NOP", "PHO": "PHX", "SEA": "OKC"}

# Conformed only after the salaries are joined.
LATE_CODES = {"NJN": "BKN"}

# Names to use for the sorted unmatched names of the salary file.
SALARY_NAMES = [
    "AJ Hammons", "AJ Price", "Domantas Sabonis", "Bennett Davis", "Boniface Ndong", "CJ Miles", "Yoeli Childs",
    "Clar. Weatherspoon", "DJ Mbenga", "DJ Stephens", "DJ Strawberry", "DJ White", "Dalibor Bagaric",
    "Efthimi Rentzias", "Eric Montross", "Pooh Jeter", "Evan Eschmyer", "Frank Mason", "Glen Rice", "Ha Seung-Jin",
    "Hakeem Olaju", "Hamady Ndiaye", "Harry Giles III", "Ibrahim Kutluay", "JJ Hickson", "JJ O'Brien", "JJ Redick",
    "JR Smith", "James Ennis III", "Jason Caffey", "Jeffery Taylor", "Jason Sasser", "Johnny O'Bryant III",
    "Joseph Forte", "Juancho Hernangomez", "Kirk Haston", "KJ McDaniels", "Mamadou N'diaye", "Marcus Morris Sr.",
    "Matt Maloney", "Michael Dickerson", "Michael Sweetney", "Muggsy Bogues", "Nate Huffman", "Otto Porter Jr.",
    "PJ Hairston", "Orlando Sanchez", "Perry Jones III", "Roger Mason Jr.", "Ronald Murray", "Shawn Kemp",
    "Slava Medvedenko", "Steven Smith", "Sun Sun", "Terrell Brandon", "Todd MacCulloch", "Wang Zhi-zhi",
    "Wes Iwundu",
]

# Names to use for the sorted unmatched names of the season statistics.
STATS_NAMES = [
    "AJ Hammons", "AJ Price", "Allen Iverson", "Alonzo Mourning", "Boniface Ndong", "CJ McCollum", "CJ Miles",
    "Clar. Weatherspoon", "DJ White", "DJ Stephens", "DJ Strawberry", "DJ White", "Danuel House Jr.",
    "Derrick Jones Jr.", "Didier Illunga-Mbenga", "Dikembe Mutombo", "Pooh Jeter", "Gary Payton", "Ha Seung-Jin",
    "Hamady Ndiaye", "Ibrahim Kutluay", "JJ Hickson", "JJ O'Brien", "JJ Redick", "JR Smith", "James Ennis III",
    "James Michael McAdoo", "John Lucas III", "Johnny O'Bryant III", "Juan Carlos Navarro", "Juancho Hernangomez",
    "KJ McDaniels", "Keith Van Horn", "Kelly Oubre Jr.", "Larry Drew II", "Larry Nance Jr.", "Luc Mbah a Moute",
    "Luigi Datone", "Mamadou N'diaye", "Marcus Morris Sr.", "Metta World Peace", "Nando De Colo", "Nene Hilario",
    "Nick Van Exel", "Otto Porter Jr.", "PJ Hairston", "Perry Jones III", "Peter John Ramos", "RJ Hunter",
    "Reggie Miller", "Roger Mason Jr.", "Ronald Murray", "Shaquille O'Neal", "Sheldon Mac", "Slava Medvedenko",
    "Steven Smith", "Sun Sun", "Taurean Prince", "Tim Hardaway Jr.", "Wade Baldwin IV", "Edy Tavares",
    "Wang Zhi-zhi", "Yao Ming",
]

# Limits and metric columns.
FIRST_SEASON, LAST_SEASON = 2005, 2017
FIRST_SALARY_END, LAST_SALARY_END = 2004, 2020
FIRST_STATS_YEAR = 2005
TOP_MEMBERS = 8
COUNTED = ["FGM", "FGA", "FG3M", "FG3A", "FTM", "FTA", "OREB", "DREB", "AST", "STL", "BLK", "TO", "PTS"]
RATES = ["OREB", "DREB", "AST", "STL", "BLK", "TO", "PTS"]
PERCENTAGES = {"FG_PCT": ("FGM", "FGA"), "FG3_PCT": ("FG3M", "FG3A"), "FT_PCT": ("FTM", "FTA")}
WIN_SHARES = ["OWS", "DWS", "WS"]
CLUSTER_SETS = {
    "off_mean": ["PTS", "FG_PCT", "AST", "OREB", "OWS"],
    "def_mean": ["STL", "TO", "BLK", "DREB", "DWS"],
    "tot_mean": ["PTS", "AST", "OREB", "STL", "BLK", "DREB", "TO", "WS", "FG_PCT"],
}
